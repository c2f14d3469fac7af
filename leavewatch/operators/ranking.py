"""Exact global positions without a global window.

A ``row_number`` over a whole table runs in one task. Here the rows are range
partitioned, sorted within each partition and numbered there; only the size
of each partition is needed to turn that into a position in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leavewatch.sources.shared_storage import cut_lineage

# monotonically_increasing_id keeps the partition above bit 33, the row below.
_ROW_BITS = 33


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the given order.

    The order must tell all rows apart. The numbered rows go to shared
    storage before they are used twice: range bounds come from a sample, and
    a second run could draw them differently.
    """
    numbered = (df.repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("_id", F.monotonically_increasing_id()))
    numbered = cut_lineage(numbered)
    part = F.shiftright("_id", _ROW_BITS)
    numbered = numbered.withColumn("_part", part)
    # One row per partition, so this window and the broadcast stay small.
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    row = F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)
    return (numbered.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + row)
            .drop("_part", "_id", "_start"))


def user_slice_bounds(users: DataFrame, slices: int = 10, key: str = "userId") -> list[str]:
    """First user id of each slice but the first, in id order.

    Slices are runs of ``int(n / slices) + 1`` ordered ids. Only these few ids
    reach the driver.
    """
    ranked = with_position(users.select(key).distinct(), key)
    size = ranked.count() // slices + 1
    firsts = (ranked.where((F.col("position") % size == 0) & (F.col("position") > 0))
              .orderBy("position").select(key).collect())
    return [row[key] for row in firsts]


def with_user_slice(log: DataFrame, bounds: list[str], key: str = "userId") -> DataFrame:
    """Add ``bucket``: the slice a user falls in.

    The bounds are one constant of the plan, so the log is neither joined nor
    shuffled, however many rows one user has, and the plan does not grow with
    the number of slices.
    """
    array = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<string>")
    return log.withColumn("bucket", F.size(F.filter(array, lambda bound: bound <= F.col(key))))
