"""Properties that hold for any log, checked on the sample and on made logs."""

import random

from compare import assert_close, assert_same
from conftest import MEDIUM
from pyspark.sql import functions as F

from leavewatch import fixed_values as fixed
from leavewatch.operators import cleaning, encoding, explore, phases, ranking, sessions, users
from leavewatch.plans import modelling
from leavewatch.plans.sql_features import SqlFeatureTransformer, UserFeatureTransformer
from leavewatch.sources import event_log
from leavewatch.sources.sample_log import read_sample_log
from leavewatch.sources.shared_storage import fresh_path


def test_row_order_and_partitions_do_not_matter(clean_log, features):
    shuffled = clean_log.repartition(13, F.rand(seed=3)).sortWithinPartitions(F.rand(seed=4))
    assert_close(users.user_features(shuffled).toPandas(), features.toPandas(), ["userId"])


def test_page_counts_add_up_to_the_log(clean_log):
    table = sessions.session_rollup(clean_log, signup_pages=True)
    pages = [*fixed.PAGE_COUNTS, *fixed.CANCEL_COUNTS, *fixed.SIGNUP_PAGE_COUNTS]
    total = table.select(sum(F.col(c) for c in pages).alias("n")).agg(F.sum("n")).head()[0]
    confirmations = clean_log.where(F.col("page") == fixed.LABEL_PAGE).count()
    assert total + confirmations == clean_log.count()


def test_sql_text_equals_columns(clean_log):
    agents = encoding.fit_labels(clean_log, ["userAgent"])["userAgent"]
    columns = UserFeatureTransformer(agents=agents).transform(clean_log)
    text = SqlFeatureTransformer(tableName="log_under_test", agents=agents).transform(clean_log)
    assert columns.columns == text.columns
    assert_close(text.toPandas(), columns.toPandas(), ["userId"])


def test_transformer_can_be_saved(spark, clean_log, features):
    path = fresh_path(spark, "stage")
    UserFeatureTransformer(guards=True).write().save(path)
    loaded = UserFeatureTransformer.load(path)
    assert_close(loaded.transform(clean_log).toPandas(), features.toPandas(), ["userId"])


def test_seconds_and_millis_agree(clean_log, features):
    seconds = clean_log.withColumns({c: F.col(c) / 1000 for c in ("ts", "registration")})
    found = users.user_features(seconds, ticks_per_second=1).toPandas()
    assert_close(found, features.toPandas(), ["userId"], 1e-3)


def test_long_browser_form_equals_wide_form(clean_log):
    agents = encoding.fit_labels(clean_log, ["userAgent"])["userAgent"]
    wide = users.user_features(clean_log, agents=agents)
    pairs = F.array(*[F.struct(F.lit(a).alias("userAgent"),
                               F.col(f"avg_userAgent_{i}_interactions").alias("avg_interactions"))
                      for i, a in enumerate(agents)])
    unpivoted = wide.select("userId", F.inline(pairs)).where("avg_interactions > 0")
    assert_close(users.user_agent_features(clean_log).toPandas(), unpivoted.toPandas(),
                 ["userId", "userAgent"])


def test_one_hot_equals_ml_stages(clean_log):
    model = encoding.one_hot_pipeline().fit(clean_log)
    labels = encoding.pipeline_labels(model)
    assert labels == encoding.fit_labels(clean_log)
    names = encoding.one_hot_names(labels)
    kept = [c for c in clean_log.columns if c not in labels]
    by_stages = encoding.unpack_vector(model.transform(clean_log), "onehot_features", names, kept)
    by_stages = by_stages.withColumnRenamed(f"page_{fixed.LABEL_PAGE}", "cancelled")
    by_columns = encoding.one_hot_events(clean_log, labels)
    assert by_columns.columns == by_stages.columns
    assert_same(by_columns.toPandas(), by_stages.toPandas())


def test_bucketed_log_gives_the_same_features(spark, features):
    from leavewatch.operators.cleaning import clean_events
    path = fresh_path(spark, "buckets")
    event_log.write_user_buckets(event_log.with_hash_bucket(read_sample_log(spark, MEDIUM)
                                                            .where("userId is not null"), 7), path)
    parts = [users.user_features(clean_events(event_log.read_user_bucket(spark, path, b), False))
             for b in range(7)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    assert_close(whole.toPandas(), features.toPandas(), ["userId"])


def test_positions_equal_a_sort(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.randrange(4), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, n int, i int").repartition(6)
    found = ranking.with_position(df, "k", F.desc("n"), "i").collect()
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r["position"])] == \
        sorted(rows, key=lambda r: (r[0], -r[1], r[2]))
    assert sorted(r["position"] for r in found) == list(range(3000))


def test_slices_hold_equal_runs_of_ids(spark):
    ids = [str(i) for i in range(103)]
    df = spark.createDataFrame([(i,) for i in ids for _ in range(2)], "userId string")
    bounds = ranking.user_slice_bounds(df, 10)
    found = {r["userId"]: r["bucket"] for r in ranking.with_user_slice(df, bounds).collect()}
    assert found == {u: n // 11 for n, u in enumerate(sorted(ids))}


def test_churn_phase_equals_brute_force(spark):
    """One user holds most rows; moments tie; cancellations repeat."""
    rng = random.Random(9)
    pages = ["Home", "Error", fixed.LABEL_PAGE]
    rows = [("u1" if rng.random() < 0.7 else rng.choice(["u2", "u3", "u4"]), rng.randrange(300),
             rng.choices(pages, [6, 3, 1])[0]) for _ in range(800)]
    rows += [("u5", t, "Home") for t in range(20)]
    log = spark.createDataFrame(rows, "userId string, ts bigint, page string")
    found = phases.churn_phase(log, slice_ticks=50)
    expected = sorted((u, t, p, int(p == fixed.LABEL_PAGE),
                       sum(1 for v, s, q in rows if v == u and s >= t and q == fixed.LABEL_PAGE))
                      for u, t, p in rows)
    got = sorted(tuple(r) for r in
                 found.select("userId", "ts", "page", "cancelled", "phase").collect())
    assert got == expected


def test_scaled_values_lie_between_0_and_1(features):
    scaled = modelling.minmax_scaled(features)
    names = modelling.feature_columns(features)
    low, high = scaled.select(F.least(*names).alias("a"), F.greatest(*names).alias("b")) \
        .agg(F.min("a"), F.max("b")).head()
    assert low >= 0 and high <= 1


def test_both_correlations_agree(features):
    names = modelling.feature_columns(features)[:8]
    assert_close(explore.correlation_pairs(features, names, True).toPandas(),
                 explore.correlation_pairs(features, names).toPandas(),
                 ["feature_i", "feature_j"])


def test_splits_follow_the_user(features):
    once = modelling.with_fold(modelling.with_split(features), 3)
    again = modelling.with_fold(modelling.with_split(features.repartition(5)), 3)
    columns = ["userId", "split", "fold"]
    assert_same(once.select(columns).toPandas(), again.select(columns).toPandas())


def test_scaling_equals_ml_stages(features):
    names = modelling.feature_columns(features)
    stages = modelling.minmax_pipeline(names).fit(features).transform(features)
    unpacked = encoding.unpack_vector(stages, "scaled_features", names, ["userId", "cancelled"])
    assert_close(modelling.minmax_scaled(features).toPandas(), unpacked.toPandas(), ["userId"])


def test_browser_features_equal_compared_labels(spark):
    log = read_sample_log(spark, MEDIUM)
    clean = cleaning.clean_events(log, seconds=False)
    agents = encoding.fit_labels(clean, ["userAgent"])["userAgent"]
    raw = cleaning.clean_events(log, seconds=False, artist=False, agent=False)
    found = users.browser_user_features(raw)
    assert found.columns == users.user_features(clean, agents=agents).columns
    assert_close(found.toPandas(), users.user_features(clean, agents=agents).toPandas(), ["userId"])


def test_buckets_beyond_a_hundred_are_even(spark):
    ids = spark.range(200_000).select(F.col("id").cast("string").alias("userId"))
    sizes = [r["count"] for r in event_log.with_hash_bucket(ids, 250).groupBy("bucket").count().collect()]
    assert len(sizes) == 250 and max(sizes) < 1.2 * 200_000 / 250
