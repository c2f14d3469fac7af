"""Cases the sample log does not hold."""

import hashlib

import pytest
from pyspark.sql import functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions import (
    cleaned_artist,
    cleaned_user_agent,
    hash_percent,
    sign_colour,
    student_975,
    user_key_by_path,
    user_key_by_pattern,
)
from leavewatch.operators import cleaning, encoding, explore, profiling, users
from leavewatch.plans import modelling, queries
from leavewatch.schema import EVENT_SCHEMA
from leavewatch.sources import event_log, shared_storage

EVENT = {"userId": "1", "sessionId": 1, "ts": 0, "registration": 0, "page": "Home",
         "itemInSession": 0, "gender": "F", "level": "free", "method": "GET", "status": 200,
         "userAgent": "a", "auth": "Logged In"}


def events(spark, *changes):
    return spark.createDataFrame([{**EVENT, **c} for c in changes], EVENT_SCHEMA)


def one(df):
    return df.collect()[0].asDict()


def test_blank_counts_as_missing_in_text_only(spark):
    df = spark.createDataFrame([("", None), (None, 0), ("a", 5)], "s string, n bigint")
    assert one(profiling.profile_missing(df)) == {"s": 2, "n": 1}
    assert one(profiling.profile_nulls(df)) == {"s": 1, "n": 1}
    assert one(profiling.profile_shape(df)) == {"n_rows": 3, "n_columns": 2}


def test_rows_without_user_or_session_go(spark):
    log = events(spark, {}, {"userId": ""}, {"userId": None}, {"sessionId": None})
    assert cleaning.drop_unkeyed_rows(log).count() == 1


def test_user_agent_words(spark):
    raw = ["Mozilla/5.0 (Windows NT 6.1; WOW64) X a b c Y", None, "\t9 \n", "é-B-é"]
    df = spark.createDataFrame([(r,) for r in raw], "ua string")
    found = [r[0] for r in df.select(cleaned_user_agent(F.col("ua"))).collect()]
    assert found == ["mozilla windows nt wow a c y", None, "", "b"]


def test_artist_keeps_its_length(spark):
    df = spark.createDataFrame([("Beyoncé & #1",)], "a string")
    assert df.select(cleaned_artist(F.col("a"))).head()[0] == "Beyonc     1"


def test_user_key_of_a_line(spark):
    df = spark.createDataFrame(
        [('{"ts":1,"userId":"30","x":"u"}',), ('{"userId": "", "x":1}',), ('{"ts":1}',)], "v string")
    for key in (user_key_by_path, user_key_by_pattern):
        assert [r[0] for r in df.select(key(F.col("v"))).collect()] == ["30", "", None]


def test_overlapping_sessions_give_a_negative_gap(spark):
    log = events(spark, {"ts": 0}, {"ts": 10_000}, {"sessionId": 2, "ts": 5_000},
                 {"sessionId": 2, "ts": 12_000})
    row = one(users.user_features(log))
    assert row["avg_time_between_sessions"] == -5.0
    assert row["total_number_of_sessions"] == 2


def test_guards(spark):
    log = events(spark, {"registration": None, "ts": 2_000, "gender": "Unknown"})
    row = one(users.user_features(log))
    assert (row["longest_song"], row["avg_song_length"], row["time_since_joined"]) == (0, 0, 0)
    assert row["avg_gender_Unknown"] == 1 and row["avg_time_between_sessions"] == 0
    bare = one(users.user_features(log, guards=False))
    assert bare["longest_song"] is None and bare["avg_song_length"] is None
    assert bare["time_since_joined"] is None and "avg_gender_Unknown" not in bare
    filled = one(users.user_features_extended(log, alternate_names=True))
    assert filled["time_since_joined"] == 0 and "avg_num_upgrade_clicks" in filled


def test_labels_with_quotes_are_counted(spark):
    label = "it's a \\ \"test\""
    row = one(users.user_features(events(spark, {"userAgent": label}, {}), agents=[label, "a"]))
    assert row["avg_userAgent_0_interactions"] == 1 and row["avg_userAgent_1_interactions"] == 1


def test_label_ties_go_by_name(spark):
    df = spark.createDataFrame([(c,) for c in "bacc"], "page string")
    assert encoding.fit_labels(df, ["page"]) == {"page": ["c", "a", "b"]}
    index = encoding.label_index(encoding.label_counts(df, ["page"]))
    assert {r["label"]: r["label_rank"] for r in index.collect()} == {"c": 0, "a": 1, "b": 2}


def test_too_many_labels_is_an_error(spark):
    df = spark.range(20).select(F.col("id").cast("string").alias("userAgent"))
    with pytest.raises(ValueError, match="more than 10"):
        encoding.fit_labels(df, ["userAgent"], max_labels=10)


def test_nulls_stay_null_when_scaled(spark):
    df = spark.createDataFrame([("a", 0, 5.0, 1.0, None), ("b", 1, None, None, None), ("c", 0, 5.0, 2.0, None)],
                               "userId string, cancelled int, k double, v double, n double")
    rows = modelling.minmax_scaled(df).orderBy("userId").collect()
    assert [(r["k"], r["v"], r["n"]) for r in rows] == [(0.5, 0.0, None), (None, None, None), (0.5, 1.0, None)]


def test_column_of_nulls_is_no_zero_column(spark):
    df = spark.createDataFrame([(0, None), (0, None)], "a int, b int")
    rows = {r["feature"]: (r["only_zeros"], r["zero_mean"]) for r in cleaning.zero_column_report(df).collect()}
    assert rows == {"a": (1, 1), "b": (0, 0)}


def test_trees_beyond_the_limit_are_an_error():
    assert modelling.capped_depths() == [2, 5, 10, 20, 30]
    with pytest.raises(ValueError, match="30 deep"):
        modelling.tree_search(depths=[100])


def test_constant_feature_scales_to_a_half(spark):
    df = spark.createDataFrame([("a", 0, 5.0, 1.0), ("b", 1, 5.0, 3.0)],
                               "userId string, cancelled int, k double, v double")
    rows = modelling.minmax_scaled(df).orderBy("userId").collect()
    assert [(r["k"], r["v"]) for r in rows] == [(0.5, 0.0), (0.5, 1.0)]


def test_schema_survives_a_column_that_starts_all_null(spark):
    path = shared_storage.fresh_path(spark, "late")
    rows = [{**EVENT, "artist": None}] * 150 + [{**EVENT, "artist": "a"}]
    event_log.write_json_log(spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1), path)
    log = event_log.read_json_log(spark, path)
    assert log.schema == EVENT_SCHEMA
    assert log.where("artist = 'a'").count() == 1
    assert set(event_log.read_json_log(spark, path, infer=True).columns) < set(log.columns)


def test_zero_rules_differ_when_values_cancel_out(spark):
    df = spark.createDataFrame([(-1, 0, 2), (1, 0, 2)], "a int, b int, c int")
    assert cleaning.drop_zero_columns(df).columns == ["a", "c"]
    assert cleaning.drop_zero_columns(df, rule="zero_mean").columns == ["c"]
    with pytest.raises(ValueError):
        cleaning.drop_zero_columns(df, rule="other")


def test_union_fills_only_lacking_columns(spark):
    left = spark.createDataFrame([("a", None)], "id string, x double")
    right = spark.createDataFrame([("b", 2)], "id string, y int")
    rows = {r["id"]: (r["x"], r["y"]) for r in cleaning.union_zero_fill(left, right).collect()}
    assert rows == {"a": (None, 0), "b": (0.0, 2)}


def test_fill_zero_takes_nan_and_null(spark):
    df = spark.createDataFrame([(float("nan"), None, "x")], "a double, b int, c string")
    assert one(cleaning.fill_zero(df)) == {"a": 0.0, "b": 0, "c": "x"}


def test_deny_by_list_and_by_table(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",)], "userId string")
    by_table = cleaning.deny_users(df, spark.createDataFrame([("2",)], "userId string"))
    assert {r[0] for r in by_table.collect()} == {"1", "3"}
    assert {r[0] for r in cleaning.deny_users(df, ["3"]).collect()} == {"1", "2"}
    assert cleaning.deny_users(df, []).count() == 3


def test_t_quantile(spark):
    expected = {1: 12.706205, 5: 2.570582, 9: 2.262157, 10: 2.228139, 30: 2.042272, 1000: 1.962339}
    df = spark.createDataFrame([(v,) for v in expected], "v int")
    for v, t in df.select("v", student_975(F.col("v"))).collect():
        assert t == pytest.approx(expected[v], abs=1e-5)
    assert spark.range(1).select(student_975(F.col("id"))).head()[0] is None


def test_sign_colour(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (1.0,)], "v double")
    assert [r[0] for r in df.select(sign_colour(F.col("v"))).collect()] == ["red", "blue", "blue"]


def test_group_of_one_has_no_half_width(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 7.0)], "cancelled int, v double")
    rows = {r["cancelled"]: r for r in explore.group_mean_ci(df, "v", "cancelled").collect()}
    assert rows[1]["mean_value"] == 7.0 and rows[1]["half_width"] is None
    assert rows[0]["half_width"] == pytest.approx(12.706204736)


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.5, 5.0), (3.0, 5.0, 5.0)], "a double, b double, k double")
    for complete in (True, False):
        found = {(r[0], r[1]): r[2]
                 for r in explore.correlation_pairs(df, ["a", "b", "k"], complete).collect()}
        assert found[("b", "a")] == pytest.approx(0.9332565)
        assert found[("k", "a")] is None and found[("k", "b")] is None and len(found) == 3


def test_pairwise_correlation_skips_incomplete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 1.0), (None, 9.0)], "a double, b double")
    assert explore.correlation_pairs(df, ["a", "b"]).head()["correlation"] == pytest.approx(-1)


def test_scores_of_known_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0), (1, 1)], "label int, prediction int")
    row = one(modelling.classification_metrics(df))
    assert row["f1_weighted"] == pytest.approx(0.7333333)
    assert row["f1_positive"] == pytest.approx(0.6666667)
    assert (row["accuracy"], row["error"], row["n_rows"]) == (0.75, 0.25, 4)


def test_hash_is_stable(spark):
    df = spark.createDataFrame([("7",), ("42",)], "id string")
    for salt in ("", "fold:"):
        expected = [int(hashlib.md5((salt + i).encode()).hexdigest()[:8], 16) % 100
                    for i in ("7", "42")]
        assert [r[0] for r in df.select(hash_percent(F.col("id"), salt)).collect()] == expected


def test_rows_and_points(spark):
    log = events(spark, {"length": 3.0}, {"length": None}, {"userId": "2", "length": None})
    assert cleaning.null_rows_of_user(log, "1").count() == 1
    df = spark.createDataFrame([(1, None), (2, 3)], "a int, b int")
    assert [r["a"] for r in cleaning.rows_with_null(df).collect()] == [1]
    summary = spark.createDataFrame([(1, 7200.0, 0.5, 4.0)], "cancelled int, "
                                    "avg_time_between_sessions double, avg_num_errors double, "
                                    "avg_num_paid_interactions double")
    points = explore.scatter_points(summary)
    assert points.count() == 3
    assert one(explore.series_points(points, "paid_gap", 1))["y"] == 2.0


def test_shared_folder_is_required_off_local(spark, monkeypatch):
    assert shared_storage.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_storage.shared_folder(Session())


def test_fixed_pages_cover_every_counter():
    counted = {**fixed.PAGE_COUNTS, **fixed.CANCEL_COUNTS, **fixed.SIGNUP_PAGE_COUNTS}
    assert set(counted.values()) | {fixed.LABEL_PAGE} == set(fixed.PAGES)


def test_changed_lines_are_counted(spark, tmp_path):
    def text(name, lines):
        spark.createDataFrame([(line,) for line in lines], "value string").repartition(3).write.text(str(tmp_path / name))
        return str(tmp_path / name)

    whole = text("whole", ["a", "b", "b", "", "d"])
    assert event_log.changed_lines(spark, whole, text("same", ["b", "", "d", "a", "b"])) == 0
    assert event_log.changed_lines(spark, whole, text("less", ["a", "b", "", "e", "d"])) == 2
    assert event_log.changed_lines(spark, whole, text("none", [])) == 4


def test_times_may_sum_to_more_than_a_long(spark, tmp_path):
    def result(n, name):
        spark.range(n).selectExpr(
            "id AS event_id", "CAST(timestamp_micros(9000000000000000000) AS TIMESTAMP_NTZ) AS ts", "id AS user_id",
            "'view' AS event_type", "CAST(1 AS DOUBLE) AS value", """'{"k": 1}' AS props""").write.parquet(f"{tmp_path}/{name}/events.parquet")
        return queries.text_copy_counts(spark, f"{tmp_path}/{name}")

    few, many = result(1000, "few"), result(2000, "many")
    assert few.schema["sum_ts"].dataType.simpleString() == "bigint" and few.head()["sum_ts"] == 9 * 10 ** 18
    assert many.schema["sum_ts"].dataType.simpleString() == "decimal(38,0)" and many.head()["sum_ts"] == 18 * 10 ** 18
    assert many.head()["n_lines"] == 2000 and many.head()["n_changed_lines"] == 0
    assert result(0, "none").head()["sum_ts"] is None
