"""Churn phase: how many cancellations lie at or after each event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leavewatch import fixed_values as fixed

HOUR_OF_MILLIS = fixed.SECONDS_PER_HOUR * fixed.MILLIS_PER_SECOND


def cancel_flag(page: str = "page") -> Column:
    return F.when(F.col(page) == fixed.LABEL_PAGE, 1).otherwise(0)


def churn_phase(log: DataFrame, slice_ticks: int = HOUR_OF_MILLIS) -> DataFrame:
    """Add ``cancelled`` per event and ``phase``, its running sum per user.

    ``phase`` is the sum of ``cancelled`` over the user's events with the same
    or a later ``ts``: the running sum by descending time, ties included.
    ``ts`` must be whole ticks.

    One window per user would sort all of a user's events in one task. The
    value depends on (user, ts) only, so events are first counted by that pair
    and then summed in two bounded steps: within a time slice (at most
    ``slice_ticks`` rows) and over the slices of a user. Only users who cancel
    take part; everyone else's phase is 0.
    """
    flagged = log.withColumn("cancelled", cancel_flag())
    time_slice = F.floor(F.col("ts") / slice_ticks)
    leavers = log.where(F.col("page") == fixed.LABEL_PAGE).select("userId").distinct()
    moments = (flagged.where(F.col("ts").isNotNull()).join(leavers, "userId", "left_semi")
               .groupBy("userId", time_slice.alias("_slice"), "ts")
               .agg(F.sum("cancelled").alias("_n"))
               .where(F.col("_slice").isNotNull()))
    later = (Window.partitionBy("userId").orderBy(F.desc("_slice"))
             .rowsBetween(Window.unboundedPreceding, -1))
    slices = (moments.groupBy("userId", "_slice").agg(F.sum("_n").alias("_n"))
              .select("userId", "_slice",
                      F.coalesce(F.sum("_n").over(later), F.lit(0)).alias("_later")))
    within = (Window.partitionBy("userId", "_slice").orderBy(F.desc("ts"))
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    phases = (moments.withColumn("_within", F.sum("_n").over(within))
              .join(slices, ["userId", "_slice"])
              .select("userId", "ts", (F.col("_within") + F.col("_later")).alias("phase"))
              .where(F.col("phase") > 0))
    # At most one match per event. Most users never cancel, so the right side
    # is small; a moment that holds much of the log is split by adaptive joins.
    return (flagged.join(phases, ["userId", "ts"], "left")
            .withColumn("phase", F.coalesce("phase", F.lit(0))))
