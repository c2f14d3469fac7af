"""The whole job on a JSON log."""

from pathlib import Path

from conftest import MEDIUM
from pyspark.sql import functions as F

from leavewatch import fixed_values as fixed
from leavewatch.plans import churn_job, modelling
from leavewatch.sources import event_log
from leavewatch.sources.sample_log import read_sample_log
from leavewatch.sources.shared_storage import fresh_path, shared_folder


def test_job_from_json_to_scores(spark):
    log_path, table_path = fresh_path(spark, "log"), fresh_path(spark, "features")
    event_log.write_json_log(read_sample_log(spark, MEDIUM), log_path)
    log = event_log.read_json_log(spark, log_path)
    fit, = churn_job.run(log, table_path, searches=[modelling.logistic_search(fixed.SMALL_LOGISTIC_GRID)], folds=2)
    table = event_log.read_features(spark, table_path)
    assert table.count() == 150
    assert {f"avg_userAgent_{i}_interactions" for i in range(5)} < set(table.columns)
    assert 0 <= fit.summary().head()["accuracy"] <= 1
    assert len(fit.features) == len(table.columns) - 2


def test_feature_options(spark):
    log = read_sample_log(spark, MEDIUM)
    options = churn_job.FeatureOptions(extended=True, agents=False, denied=["8"], drop_zeros=True)
    table = churn_job.build_features(log, options)
    assert table.count() == 149
    assert "avg_num_login_visits" in table.columns


def test_thousand_browsers(spark):
    log = spark.range(3000).select(
        F.col("id").cast("string").substr(1, 2).alias("userId"), (F.col("id") % 7).alias("sessionId"),
        F.col("id").alias("ts"), F.lit(0).cast("long").alias("registration"), F.lit("Home").alias("page"),
        F.concat(F.lit("agent "), F.translate((F.col("id") % 1000).cast("string"), "0123456789", "abcdefghij"), F.lit("zz")).alias("userAgent"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (
            ("auth", "string"), ("firstName", "string"), ("lastName", "string"), ("artist", "string"), ("gender", "string"),
            ("itemInSession", "long"), ("length", "double"), ("level", "string"), ("location", "string"), ("method", "string"),
            ("song", "string"), ("status", "long"))])
    table = churn_job.build_features(log)
    names = [c for c in table.columns if c.startswith("avg_userAgent_")]
    assert len(names) == 1000
    total = F.aggregate(F.array(*names), F.lit(0.0), lambda n, x: n + x)
    row = table.select((total * F.col("total_number_of_sessions")).alias("n")).agg(F.sum("n")).head()
    assert round(row[0]) == 3000


def test_job_leaves_only_the_feature_table(spark, capsys):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    log_path, table_path = fresh_path(spark, "log"), fresh_path(spark, "features")
    read_sample_log(spark, MEDIUM).write.parquet(log_path)
    before = set(folder.iterdir())
    churn_job.main(["--log", log_path, "--features", table_path, "--format", "parquet", "--folds", "2"])
    assert {p.name for p in set(folder.iterdir()) - before} == {table_path.rpartition("/")[2]}
    assert "f1_weighted" in capsys.readouterr().out


def test_job_goes_on_from_its_scores(spark, capsys, tmp_path):
    log_path, scores = fresh_path(spark, "log"), str(tmp_path / "scores")
    read_sample_log(spark, MEDIUM).write.parquet(log_path)
    for run in ("first", "second"):
        churn_job.main(["--log", log_path, "--features", str(tmp_path / run), "--format", "parquet", "--folds", "2",
                        "--estimators", "trees", "--rounds", "1", "--scores", scores])
    both = capsys.readouterr().out
    assert both.count("max_depth=100, min_samples_split=32") >= 2
    kept = spark.read.option("recursiveFileLookup", True).parquet(scores)
    assert kept.count() == 20 * 2  # the second run fitted nothing anew
