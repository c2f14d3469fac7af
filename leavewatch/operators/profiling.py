"""Profiles of the log and of the user table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def profile_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: per column, how many values are null or, in text, blank."""
    kinds = dict(df.dtypes)
    blank = {c: f" OR `{c}` = ''" if kinds[c] == "string" else "" for c in columns or df.columns}
    return df.agg(*[F.expr(f"count_if(`{c}` IS NULL{also}) AS `{c}`") for c, also in blank.items()])


def profile_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: per column, how many values are null."""
    return df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in columns or df.columns])


def profile_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


def auth_page_counts(log: DataFrame) -> DataFrame:
    """Events per (auth, page): shows how auth gives the label away."""
    return log.groupBy("auth", "page").agg(F.count("page").alias("n_events"))


def distinct_users(log: DataFrame) -> DataFrame:
    return log.select("userId").distinct()
