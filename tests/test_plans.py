"""The physical plans are the intended ones."""

import re

import pytest
from conftest import MEDIUM

from leavewatch.operators import cleaning, phases, ranking, users
from leavewatch.plans import churn_job
from leavewatch.plans.queries import QUERIES
from leavewatch.sources import event_log
from leavewatch.sources.sample_log import read_sample_log
from leavewatch.sources.shared_storage import cut_lineage, fresh_path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_log(spark):
    return cut_lineage(read_sample_log(spark, MEDIUM))


def test_two_shuffles_with_map_side_reduction(stored_log):
    plan = plan_of(users.user_features(cleaning.clean_events(stored_log, seconds=False)))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^,]*)", plan)
    assert len(exchanges) == 2
    assert plan.count("partial_") > 0 and "SortAggregate" not in plan


def test_filters_and_columns_reach_the_scan(stored_log):
    plan = plan_of(users.user_features(cleaning.clean_events(stored_log, seconds=False)))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "IsNotNull(sessionId)" in pushed and "IsNotNull(userId)" in pushed
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {
        "gender", "itemInSession", "length", "level", "method", "page", "registration",
        "sessionId", "song", "status", "ts", "userId"}


@pytest.mark.parametrize("name", ["clean_events", "one_hot_events", "session_rollup",
                                  "user_features", "churn_phase", "label_index",
                                  "user_agent_features", "group_mean_ci", "minmax_scaled"])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, MEDIUM))
    for unwanted in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert unwanted not in plan


def test_bucket_scan_lists_one_folder(spark, stored_log):
    path = fresh_path(spark, "pruned")
    event_log.write_user_buckets(event_log.with_hash_bucket(stored_log.where("userId <> ''")), path)
    bucket = event_log.read_user_bucket(spark, path, 3)
    assert {f.split("/")[-2] for f in bucket.inputFiles()} == {"bucket=3"}
    assert "PartitionFilters: []" in plan_of(bucket)  # nothing was listed that would have to be left out
    assert {r["bucket"] for r in bucket.select("bucket").distinct().collect()} == {3}


def test_churn_phase_shuffles_the_log_thrice_at_most(spark, stored_log):
    clean = cut_lineage(cleaning.clean_events(stored_log, seconds=False))
    plan = plan_of(phases.churn_phase(clean))
    assert "left_semi" in plan.lower() or "LeftSemi" in plan
    assert plan.count("Window") >= 2


def test_job_scans_the_log_once(spark, stored_log, monkeypatch):
    stored = []
    real = cut_lineage

    def noted(df):
        stored.append(plan_of(df))
        return real(df)

    monkeypatch.setattr(users, "cut_lineage", noted)
    features = churn_job.build_features(stored_log)
    assert len(stored) == 1 and stored[0].count("FileScan") == 1
    assert "userAgent" in stored[0] and not set(re.findall(r"FileScan parquet \[([^\]]*)\]", stored[0])) & set(
        re.findall(r"FileScan parquet \[([^\]]*)\]", plan_of(features)))


def test_slices_need_no_shuffle_of_the_log(stored_log):
    assert "Exchange" not in plan_of(ranking.with_user_slice(stored_log, ["b", "c"]))


def test_browser_features_scan_the_log_once(spark):
    df = QUERIES["user_agent_features"](spark, MEDIUM)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
