"""Comparison of users who left with users who stayed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.numeric import guarded_ratio, hours, student_975
from leavewatch.operators.sessions import session_measures
from leavewatch.sources.shared_storage import cut_lineage

TIME_MEASURES = ["avg_time_between_sessions", "avg_session_length"]


def eda_user_summary(log: DataFrame,
                     ticks_per_second: int = fixed.MILLIS_PER_SECOND) -> DataFrame:
    """Eight measures per user, without null guards, times in seconds.

    Session measures that are not read here are pruned from the plan.
    """
    n_sessions = F.count("sessionId")
    idle = (F.max("session_end") - F.min("session_begin")) - F.sum("session_length")
    sessions = session_measures(log, guards=False)
    return sessions.groupBy("userId").agg(
        (guarded_ratio(idle, n_sessions - 1) / ticks_per_second)
        .alias("avg_time_between_sessions"),
        (F.avg("session_length") / ticks_per_second).alias("avg_session_length"),
        F.avg("gender_F").alias("avg_gender_F"),
        F.try_divide(F.sum("session_listening_time"), n_sessions)
        .alias("listening_time_per_session"),
        n_sessions.alias("total_number_of_sessions"),
        F.avg("num_errors").alias("avg_num_errors"),
        F.avg("num_paid_interactions").alias("avg_num_paid_interactions"),
        F.max("cancelled").alias("cancelled"),
    )


def group_mean_ci(df: DataFrame, targets: str | Sequence[str], groups: str | Sequence[str],
                  freedom: str = "n-1", in_hours: Sequence[str] = ()) -> DataFrame:
    """Mean and 95 % half-width of each target in each group, in long form.

    All targets share one aggregate. ``freedom="n"`` takes the t quantile at n
    degrees of freedom in place of n - 1. Targets named in ``in_hours`` are
    turned from seconds into hours; counts are not times and stay as they are.
    """
    targets = [targets] if isinstance(targets, str) else list(targets)
    groups = [groups] if isinstance(groups, str) else list(groups)
    if freedom not in ("n", "n-1"):
        raise ValueError(f"unknown freedom: {freedom}")
    stats = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(targets):
        stats += [F.avg(c).alias(f"_mean{i}"), F.stddev_samp(c).alias(f"_sd{i}")]
    summary = df.na.drop("any", subset=groups).groupBy(*groups).agg(*stats)
    n = F.col("_n")
    quantile = student_975(n if freedom == "n" else n - 1)
    summary = summary.withColumn("_t", quantile)

    def entry(i: int, c: str):
        mean = F.col(f"_mean{i}")
        half = F.col(f"_sd{i}") / F.sqrt(n) * F.col("_t")
        if c in in_hours:
            mean, half = hours(mean), hours(half)
        return F.struct(F.lit(c).alias("target"), mean.alias("mean_value"),
                        half.alias("half_width"))

    entries = F.array(*[entry(i, c) for i, c in enumerate(targets)])
    return summary.select(*groups, n.alias("n_rows"), F.inline(entries))


def scatter_points(summary: DataFrame) -> DataFrame:
    """Point series for three pairs of measures, in long form, gaps in hours."""
    gap = hours(F.col("avg_time_between_sessions"))
    errors, paid = F.col("avg_num_errors"), F.col("avg_num_paid_interactions")
    series = [("errors_gap", errors, gap), ("errors_paid", errors, paid), ("paid_gap", paid, gap)]
    points = F.array(*[
        F.struct(F.lit(name).alias("series"), x.alias("x"), y.alias("y")) for name, x, y in series
    ])
    return summary.select("cancelled", F.inline(points))


def series_points(points: DataFrame, series: str, cancelled: int) -> DataFrame:
    """One colour of one plot."""
    return points.where((F.col("series") == series) & (F.col("cancelled") == cancelled))


def correlation_pairs(df: DataFrame, columns: Sequence[str],
                      complete: bool = False) -> DataFrame:
    """Pearson correlation of every pair of columns, once per pair.

    Gives the strict lower triangle: ``feature_i`` comes after ``feature_j``.
    A constant column has no correlation, hence null.

    Each pair uses the rows in which both values are present. A caller who
    knows that no value is null says ``complete``: then the matrix is one
    distributed product, whose columns-by-columns result is all that the driver
    sees. It takes more than one pass, so the columns go to shared storage
    first.
    """
    columns = list(columns)
    if complete:
        return _from_matrix(df, columns)
    return _from_masked_products(df, columns)


_SUMS = ["n", "odd", "x", "y", "xx", "yy", "xy"]


def _from_masked_products(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per pair the sums over the rows that hold both values, as products of masked matrices.

    A task gives one row of sums per pair, whatever its number of rows. Values
    are taken less the column's mean, so that little cancels.
    """
    k = len(columns)
    stored = cut_lineage(df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    finite = [F.when(F.abs(f"c{i}") < float("inf"), F.col(f"c{i}")) for i in range(k)]
    means = np.array([m or 0.0 for m in stored.agg(*[F.avg(v) for v in finite]).head()])
    place = np.tril_indices(k, -1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(_SUMS), len(place[0])))
        for batch in batches:
            there = np.column_stack([np.asarray(c.is_valid()) for c in batch.columns]).astype(float)
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - means
            good = np.isfinite(values)
            x, there_and_good = np.where(good, values, 0.0), good.astype(float)
            both = there_and_good.T @ there_and_good
            sums = x.T @ there_and_good
            squares = (x * x).T @ there_and_good
            total += np.stack([m[place] for m in (both, there.T @ there - both, sums, sums.T, squares, squares.T, x.T @ x)])
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)) for p in place] + [pa.array(t) for t in total], ["i", "j", *_SUMS])

    parts = stored.mapInArrow(work, "i int, j int, " + ", ".join(f"{c} double" for c in _SUMS))
    pairs = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _SUMS])
    n = F.nullif(F.col("n"), F.lit(0.0))

    def spread(s: str, ss: str) -> Column:
        """Sum of squares around the mean; what rounding leaves of a constant is 0."""
        left = F.col(ss) - F.col(s) * F.col(s) / n
        return F.when(left > 1e-12 * F.col(ss), left).otherwise(0.0)

    r = F.try_divide(F.col("xy") - F.col("x") * F.col("y") / n, F.sqrt(spread("x", "xx")) * F.sqrt(spread("y", "yy")))
    defined = (n > 1) & (spread("x", "xx") > 0) & (spread("y", "yy") > 0)
    names = F.array(*[F.lit(c) for c in columns])
    return pairs.select(names[F.col("i")].alias("feature_i"), names[F.col("j")].alias("feature_j"),
                        F.when(F.col("odd") > 0, float("nan")).when(defined, F.greatest(F.least(r, F.lit(1.0)), F.lit(-1.0))).alias("correlation"))


def _from_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    stored = cut_lineage(df.select(*columns))
    assembled = VectorAssembler(inputCols=columns, outputCol="_v").transform(stored)
    matrix = Correlation.corr(assembled, "_v").head()[0].toArray()
    rows = [
        (columns[i], columns[j], None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i in range(len(columns)) for j in range(i)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature_i string, feature_j string, correlation double")
