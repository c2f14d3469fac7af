"""The registered queries: name -> (session, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.text import (
    cleaned_artist,
    cleaned_user_agent,
    user_key_by_path,
    user_key_by_pattern,
)
from leavewatch.operators import cleaning, encoding, explore, label_vectors, phases, profiling, ranking, sessions, users
from leavewatch.operators.label_dictionary import LabelDictionary
from leavewatch.operators.session_store import SessionStore
from leavewatch.plans import elastic_net, modelling, tree_grid
from leavewatch.plans.score_table import ScoreTable
from leavewatch.plans.sql_features import SqlFeatureTransformer, UserFeatureTransformer
from leavewatch.sources import event_log
from leavewatch.sources.published import publish_table, read_published
from leavewatch.sources.sample_log import read_sample_log
from leavewatch.sources.shared_storage import cut_lineage, fresh_path

BUCKETS = 10
DENIED = ["11", "29", "1261737"]
LOOKED_UP = "8"
NO_BROWSER = "no such browser"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def rounded(df: DataFrame, places: int = 8) -> DataFrame:
    """Round the doubles, so that the order of float sums does not show."""
    return df.selectExpr(*[f"round(`{c}`, {places}) AS `{c}`" if kind == "double" else f"`{c}`"
                           for c, kind in df.dtypes])


def _clean(spark: SparkSession, folder: str, seconds: bool = False) -> DataFrame:
    return cleaning.clean_events(read_sample_log(spark, folder), seconds=seconds)


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return users.user_features(_clean(spark, folder))


def _unguarded(spark: SparkSession, folder: str) -> DataFrame:
    return users.user_features(_clean(spark, folder), guards=False)


def _agents(spark: SparkSession, folder: str) -> list[str]:
    keyed = cleaning.drop_unkeyed_rows(read_sample_log(spark, folder))
    return encoding.fit_labels(keyed, ["userAgent"], clean_agents=True)["userAgent"]


# ---- scans, sources, sinks --------------------------------------------------

@_query
def scan_json_roundtrip(spark, folder):
    path = fresh_path(spark, "json-log")
    event_log.write_json_log(read_sample_log(spark, folder), path)
    # Integers with nulls go out as text: many consumers would make them floats.
    return event_log.read_json_log(spark, path).withColumns(
        {c: F.col(c).cast("string") for c in ("registration", "sessionId")})


@_query
def user_bucket_assign(spark, folder):
    ids = profiling.distinct_users(_clean(spark, folder))
    return ranking.with_user_slice(ids, ranking.user_slice_bounds(ids, BUCKETS))


@_query
def user_bucket_counts(spark, folder):
    log = _clean(spark, folder)
    sliced = ranking.with_user_slice(log, ranking.user_slice_bounds(log, BUCKETS))
    return _bucket_sizes(sliced)


@_query
def user_hash_bucket_counts(spark, folder):
    return _bucket_sizes(event_log.with_hash_bucket(_clean(spark, folder), BUCKETS))


def _bucket_sizes(bucketed: DataFrame) -> DataFrame:
    per_user = bucketed.groupBy("bucket", "userId").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("n").alias("n_events"))


def _split_and_read(spark: SparkSession, bucketed: DataFrame) -> DataFrame:
    """Write one folder per bucket, then read and roll up one at a time."""
    path = fresh_path(spark, "user-buckets")
    event_log.write_user_buckets(bucketed, path)
    parts = [
        event_log.read_user_bucket(spark, path, bucket)
        .groupBy("bucket", "userId").agg(F.count(F.lit(1)).alias("n_events"),
                                         F.max("ts").alias("last_ts"))
        for bucket in range(BUCKETS)
    ]
    return reduce(DataFrame.unionByName, parts)


@_query
def scan_bucket_pruned(spark, folder):
    keyed = cleaning.drop_unkeyed_rows(read_sample_log(spark, folder))
    return _split_and_read(spark, event_log.with_hash_bucket(keyed, BUCKETS))


@_query
def scan_slice_pruned(spark, folder):
    keyed = cleaning.drop_unkeyed_rows(read_sample_log(spark, folder))
    bounds = ranking.user_slice_bounds(keyed, BUCKETS)
    return _split_and_read(spark, ranking.with_user_slice(keyed, bounds))


@_query
def text_copy_counts(spark, folder):
    source, target = fresh_path(spark, "json-log"), fresh_path(spark, "text-copy")
    event_log.write_json_log(read_sample_log(spark, folder), source)
    event_log.copy_text_lines(spark, source, target)
    lines = spark.read.text(target)
    counts = lines.agg(F.count(F.lit(1)).alias("n_lines"),
                       F.count(user_key_by_pattern(F.col("value"))).alias("n_keyed_lines"))
    changed = event_log.changed_lines(spark, source, target)
    parsed = event_log.read_json_log(spark, target).agg(
        F.sum(F.col("ts").cast("decimal(20,0)")).cast("decimal(38,0)"), F.count("song"), F.count("userAgent")).head()
    return counts.select("*", *[_whole(v).alias(n) for n, v in zip(
        ("n_changed_lines", "sum_ts", "n_songs", "n_agents"), (changed, *parsed))])


def _whole(value: int | Decimal | None) -> Column:
    """A constant as long, or as decimal(38,0) where a long is too short: some 5 million times in milliseconds sum to more."""
    fits = value is None or -(1 << 63) <= value < 1 << 63
    return F.lit(value).cast("long" if fits else "decimal(38,0)")


@_query
def extract_user_key(spark, folder):
    lines = read_sample_log(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    return (lines.groupBy(user_key_by_path(F.col("value")).alias("key_by_path"),
                          user_key_by_pattern(F.col("value")).alias("key_by_pattern"))
            .agg(F.count(F.lit(1)).alias("n_lines")))


@_query
def sink_user_features(spark, folder):
    path = fresh_path(spark, "user-features")
    event_log.write_features(_features(spark, folder), path)
    return rounded(event_log.read_features(spark, path))


# ---- profiles and cleaning --------------------------------------------------

@_query
def distinct_users(spark, folder):
    return profiling.distinct_users(_clean(spark, folder))


@_query
def profile_missing(spark, folder):
    return profiling.profile_missing(read_sample_log(spark, folder))


@_query
def profile_missing_clean(spark, folder):
    return profiling.profile_missing(_clean(spark, folder))


@_query
def profile_null_features(spark, folder):
    return profiling.profile_nulls(_unguarded(spark, folder))


@_query
def profile_shape(spark, folder):
    return profiling.profile_shape(read_sample_log(spark, folder))


@_query
def auth_page_counts(spark, folder):
    return profiling.auth_page_counts(cleaning.drop_unkeyed_rows(read_sample_log(spark, folder)))


@_query
def clean_events(spark, folder):
    return _clean(spark, folder, seconds=True)


@_query
def clean_artist(spark, folder):
    log = read_sample_log(spark, folder)
    counts = log.groupBy("artist").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.withColumn("cleaned", cleaned_artist(F.col("artist")))


@_query
def clean_user_agent(spark, folder):
    log = read_sample_log(spark, folder)
    counts = log.groupBy("userAgent").agg(F.count(F.lit(1)).alias("n_events"))
    return counts.withColumn("cleaned", cleaned_user_agent(F.col("userAgent")))


@_query
def deny_users(spark, folder):
    log = cleaning.deny_users(_clean(spark, folder), DENIED)
    return log.groupBy("userId").agg(F.count(F.lit(1)).alias("n_events"))


@_query
def deny_users_by_table(spark, folder):
    """Deny every user who has cancelled."""
    log = _clean(spark, folder)
    gone = log.where(F.col("page") == fixed.LABEL_PAGE).select("userId").distinct()
    counts = log.groupBy("userId").agg(F.count(F.lit(1)).alias("n_events"))
    return cleaning.deny_users(counts, gone)


@_query
def rows_with_null(spark, folder):
    return rounded(cleaning.rows_with_null(_unguarded(spark, folder)))


@_query
def user_null_length_rows(spark, folder):
    return cleaning.null_rows_of_user(_clean(spark, folder), LOOKED_UP)


@_query
def zero_column_report(spark, folder):
    return rounded(cleaning.zero_column_report(_features(spark, folder)))


@_query
def drop_zero_columns(spark, folder):
    """The column of a browser that no user has is all zeros, so it goes."""
    table = users.user_features(_clean(spark, folder), agents=[NO_BROWSER])
    return rounded(cleaning.drop_zero_columns(table))


@_query
def union_zero_fill(spark, folder):
    """The user table with and without the sign-up pages."""
    clean = _clean(spark, folder)
    return rounded(cleaning.union_zero_fill(users.user_features(clean),
                                            users.user_features(clean, signup_pages=True)))


# ---- encoding ---------------------------------------------------------------

def _raw_categories(spark, folder):
    """Keyed rows with raw browser strings, for label counts."""
    keyed = cleaning.drop_unkeyed_rows(read_sample_log(spark, folder))
    return cleaning.fill_unknown(keyed, ["gender"])


@_query
def label_index(spark, folder):
    return encoding.label_index(
        encoding.label_counts(_raw_categories(spark, folder), clean_agents=True))


@_query
def one_hot_events(spark, folder):
    labels = encoding.fit_labels(_raw_categories(spark, folder), clean_agents=True)
    return encoding.one_hot_events(_clean(spark, folder, seconds=True), labels)


@_query
def one_hot_pipeline_events(spark, folder):
    """The same encoding by ML stages, unpacked to columns."""
    log = _clean(spark, folder, seconds=True)
    model = encoding.one_hot_pipeline().fit(log)
    labels = encoding.pipeline_labels(model)
    kept = [c for c in log.columns if c not in labels]
    columns = encoding.unpack_vector(model.transform(log), "onehot_features",
                                     encoding.one_hot_names(labels), kept)
    return columns.withColumnRenamed(f"page_{fixed.LABEL_PAGE}", "cancelled")


# ---- rollups ----------------------------------------------------------------

@_query
def session_rollup(spark, folder):
    return rounded(sessions.session_rollup(_clean(spark, folder), signup_pages=True))


@_query
def user_features(spark, folder):
    return rounded(_features(spark, folder))


@_query
def user_features_unguarded(spark, folder):
    return rounded(_unguarded(spark, folder))


@_query
def user_features_extended(spark, folder):
    return rounded(users.user_features_extended(_clean(spark, folder), alternate_names=True))


@_query
def user_features_wide(spark, folder):
    """With one column per browser, from one stored rollup."""
    clean = cleaning.clean_events(read_sample_log(spark, folder), seconds=False, artist=False, agent=False)
    return rounded(users.browser_user_features(clean))


@_query
def user_features_transformer(spark, folder):
    """With one column per browser, through the ML transformer."""
    stage = UserFeatureTransformer(agents=_agents(spark, folder))
    return rounded(stage.transform(_clean(spark, folder)))


@_query
def sql_user_features(spark, folder):
    stage = SqlFeatureTransformer(tableName="event_log", agents=_agents(spark, folder))
    return rounded(stage.transform(_clean(spark, folder)))


@_query
def user_agent_features(spark, folder):
    keyed = cleaning.drop_unkeyed_rows(read_sample_log(spark, folder))
    return rounded(users.user_agent_features(keyed, clean_agents=True))


@_query
def user_label_vectors(spark, folder):
    """Mean events per session by artist as a sparse vector per user, in its long form."""
    vectors = label_vectors.label_mean_vectors(_clean(spark, folder), "artist")
    return rounded(label_vectors.vector_entries(vectors, "labels", ["userId"]))


@_query
def churn_phase(spark, folder):
    return (phases.churn_phase(_clean(spark, folder))
            .select("userId", "sessionId", "ts", "page", "cancelled", "phase"))


# ---- a log that grows ---------------------------------------------------------

CHUNKS, LATE, REPEATED = 10, 3, 5
DICTIONARY_COLUMNS = ["userId", "userAgent", "page", "artist"]


def _chunks(log: DataFrame) -> list[tuple[str, DataFrame]]:
    """The log by slices of time as they come in: one late, one twice."""
    stored = cut_lineage(log)
    first, last = stored.agg(F.min("ts"), F.max("ts")).head()
    place = F.expr(f"(ts - {first}) * {CHUNKS} div {last - first + 1}")
    order = [i for i in range(CHUNKS) if i != LATE] + [REPEATED, LATE]
    return [(f"part-{i}", stored.where(place == i)) for i in order]


@_query
def user_features_incremental(spark, folder):
    """The user table after ten chunks, brought up to date before and after the late one."""
    store = SessionStore(spark, fresh_path(spark, "sessions"), buckets=4)
    *timely, late = _chunks(_clean(spark, folder))
    for name, log in timely:
        store.add_chunk(name, log)
    store.refresh()
    store.add_chunk(*late)
    store.refresh()
    return rounded(store.features())


@_query
def label_dictionary_growth(spark, folder):
    labels = LabelDictionary(spark, fresh_path(spark, "labels"))
    for name, log in _chunks(_clean(spark, folder)):
        labels.add_chunk(name, log, DICTIONARY_COLUMNS)
    return labels.read()


@_query
def published_features(spark, folder):
    """The user table published twice: readers see the second."""
    path, features = fresh_path(spark, "published"), _features(spark, folder)
    publish_table(features.where("cancelled = 1"), path)
    publish_table(features, path)
    return rounded(read_published(spark, path))


# ---- exploration ------------------------------------------------------------

def _summary(spark, folder):
    return explore.eda_user_summary(_clean(spark, folder))


@_query
def eda_user_summary(spark, folder):
    return rounded(_summary(spark, folder))


@_query
def group_mean_ci(spark, folder):
    targets = ["avg_num_errors", "total_number_of_sessions", "avg_num_paid_interactions",
               "avg_gender_F"]
    return rounded(explore.group_mean_ci(_summary(spark, folder), targets, "cancelled", "n"))


@_query
def group_mean_ci_hours(spark, folder):
    times = explore.TIME_MEASURES
    return rounded(explore.group_mean_ci(_summary(spark, folder), times, "cancelled", "n", times))


@_query
def group_mean_ci_by_gender(spark, folder):
    return rounded(explore.group_mean_ci(_summary(spark, folder), "avg_time_between_sessions",
                                         ["avg_gender_F", "cancelled"]))


@_query
def scatter_points(spark, folder):
    return rounded(explore.scatter_points(_summary(spark, folder)))


@_query
def series_points(spark, folder):
    """The same points, taken one series and one class at a time."""
    points = cut_lineage(explore.scatter_points(_summary(spark, folder)))
    return rounded(reduce(DataFrame.unionByName, [
        explore.series_points(points, series, cancelled)
        for series in ("errors_gap", "errors_paid", "paid_gap") for cancelled in (0, 1)]))


@_query
def correlation_pairs(spark, folder):
    """The guarded table holds no null."""
    table = _features(spark, folder)
    return rounded(explore.correlation_pairs(table, table.columns[1:], complete=True), 6)


@_query
def correlation_pairs_unguarded(spark, folder):
    table = _unguarded(spark, folder)
    return rounded(explore.correlation_pairs(table, table.columns[1:]), 6)


# ---- modelling --------------------------------------------------------------

@_query
def minmax_scaled(spark, folder):
    return rounded(modelling.minmax_scaled(_features(spark, folder)))


@_query
def minmax_scaled_unguarded(spark, folder):
    return rounded(modelling.minmax_scaled(_unguarded(spark, folder)))


@_query
def train_test_split(spark, folder):
    split = modelling.with_split(_features(spark, folder))
    return modelling.with_fold(split, 3).select("userId", "split", "fold")


@_query
def base_rate(spark, folder):
    return rounded(modelling.base_rate(modelling.with_split(_features(spark, folder))))


@_query
def classification_metrics(spark, folder):
    """Scores of a plain rule: many errors per session foretell leaving."""
    rule = F.when(F.col("avg_num_errors") > 0.4, 1).otherwise(0)
    guess = _features(spark, folder).select(F.col("cancelled").alias("label"),
                                            rule.alias("prediction"))
    return rounded(modelling.classification_metrics(guess))


# The optimum of a penalised fit is unique, so SQL that finds it by another
# method gives the same coefficients, probabilities and scores.

def six(value: Column) -> Column:
    """Rounded to six digits; no negative zero."""
    return F.when(F.abs(value) < 0.0000005, 0.0).otherwise(F.round(value, 6))


def _small_logistic(spark, folder):
    return elastic_net.fit_elastic_models(
        _features(spark, folder), elastic_net.penalty_points(fixed.SMALL_LOGISTIC_GRID),
        folds=2, test_percent=20, fit_scope="all")


def _large_logistic(spark, folder, scores=None):
    return elastic_net.fit_elastic_models(_features(spark, folder), elastic_net.penalty_points(), scores=scores)


@_query
def churn_logreg_cv(spark, folder):
    return rounded(_small_logistic(spark, folder).summary())


@_query
def churn_predictions(spark, folder):
    return _small_logistic(spark, folder).predictions.withColumn("probability", six(F.col("probability")))


def _coefficients(fit, ascending=False):
    return fit.coefficient_table(ascending).withColumns(
        {c: six(F.col(c)) for c in ("coefficient", "abs_coefficient")})


@_query
def churn_coefficients(spark, folder):
    return _coefficients(_small_logistic(spark, folder))


@_query
def churn_coefficients_rising(spark, folder):
    return _coefficients(_small_logistic(spark, folder), ascending=True)


@_query
def churn_certificate(spark, folder):
    """Gradient of the loss at every returned coefficient, and whether the penalty explains it."""
    found = _large_logistic(spark, folder).certificate()
    return found.select("feature", *[six(F.col(c)).alias(c) for c in ("coefficient", "gradient", "lasso")],
                        (F.col("distance") < 1e-8).cast("int").alias("optimal"))


@_query
def grid_results(spark, folder):
    return rounded(_large_logistic(spark, folder).grid)


@_query
def grid_fold_scores(spark, folder):
    """The score of every point and fold, read from the table that a search keeps."""
    scores = ScoreTable(spark, fresh_path(spark, "scores"))
    _large_logistic(spark, folder, scores)
    return rounded(scores.read())


@_query
def churn_elastic_cv(spark, folder):
    """The whole grid, penalty given as inverse strength, scored by the F1 of the cancelled."""
    fit = elastic_net.fit_elastic_models(
        _features(spark, folder), elastic_net.inverse_strength_points(), folds=5, metric="fMeasureByLabel",
        standardised=False)
    held_out = fit.summary().select("params", "n_train", "n_test", "f1_positive", "accuracy")
    return rounded(fit.grid.join(F.broadcast(held_out), "params", "left"))  # one row


@_query
def churn_gbt_cv(spark, folder):
    """The whole grid of boosted trees in 5 folds, up to 100 rounds, ended early by a fifth of each fit's own rows."""
    scores = ScoreTable(spark, fresh_path(spark, "scores"))
    fit = tree_grid.fit_tree_models(_features(spark, folder), tree_grid.tree_points(), scores, stop_percent=20)
    return rounded(fit.grid)
