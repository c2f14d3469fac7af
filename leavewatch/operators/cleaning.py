"""Row filters and column edits that turn the raw log into the clean log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.text import cleaned_artist, cleaned_user_agent
from leavewatch.sources.shared_storage import cut_lineage


def drop_unkeyed_rows(log: DataFrame) -> DataFrame:
    """Drop rows without a user or session; a blank user id counts as none.

    Plain comparisons, unlike ``na.drop``, are pushed down to the scan.
    """
    return log.where(F.col("userId").isNotNull() & (F.col("userId") != "")
                     & F.col("sessionId").isNotNull())


def millis_to_seconds(df: DataFrame, columns: Sequence[str] = ("ts", "registration")) -> DataFrame:
    return df.withColumns({c: F.col(c) / fixed.MILLIS_PER_SECOND for c in columns})


def drop_identity_columns(log: DataFrame) -> DataFrame:
    return log.drop(*fixed.IDENTITY_COLUMNS)


def clean_text(log: DataFrame, artist: bool = True, agent: bool = True) -> DataFrame:
    """Simplify, if asked, the browser string and the artist name."""
    edits = {}
    if agent:
        edits["userAgent"] = cleaned_user_agent(F.col("userAgent"))
    if artist:
        edits["artist"] = cleaned_artist(F.col("artist"))
    return log.withColumns(edits)


def fill_unknown(log: DataFrame, columns: Sequence[str] = tuple(fixed.FILLED_COLUMNS)) -> DataFrame:
    return log.na.fill(fixed.UNKNOWN, subset=list(columns))


def fill_registration(log: DataFrame) -> DataFrame:
    """A row without a registration time takes its own event time."""
    return log.withColumn("registration", F.coalesce("registration", "ts"))


def clean_events(log: DataFrame, seconds: bool = True, artist: bool = True,
                 agent: bool = True) -> DataFrame:
    """The clean log: keyed rows, no identities, simple text, no null category.

    The rollups want ``seconds=False``: they subtract whole milliseconds and
    divide once, at the end. Those that clean browser strings once they have
    been counted want ``agent=False``.
    """
    clean = drop_identity_columns(drop_unkeyed_rows(log))
    clean = clean_text(clean, artist, agent)
    clean = fill_unknown(clean) if agent else fill_unknown(clean, ["gender"])
    return millis_to_seconds(clean) if seconds else clean


def deny_users(df: DataFrame, denied: Sequence[str] | DataFrame, key: str = "userId") -> DataFrame:
    """Drop the rows of denied users: a short list, or a DataFrame of any length."""
    if isinstance(denied, DataFrame):
        return df.join(denied.select(key), key, "left_anti")
    return df.where(~F.col(key).isin(list(denied))) if denied else df


def rename_features(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def fill_zero(df: DataFrame) -> DataFrame:
    """Nulls and NaNs of every numeric column become 0."""
    return df.na.fill(0).na.replace(float("nan"), 0.0)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.isnull(c) for c in columns))


def rows_with_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which at least one of the columns is null."""
    return df.where(any_null(columns or df.columns))


def null_rows_of_user(log: DataFrame, user_id: str, column: str = "length") -> DataFrame:
    """The rows of one user in which a column is null."""
    return log.where((F.col("userId") == user_id) & F.isnull(column))


def _numeric_columns(df: DataFrame) -> list[str]:
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return [name for name, kind in df.dtypes if kind in plain]


def zero_column_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: minimum, maximum, mean, both zero tests.

    One aggregate over the table; the statistics become rows only after it. A
    column of nulls holds no zero and fails both tests.
    """
    names = list(columns or _numeric_columns(df))
    stats = df.agg(*[
        F.expr(f"named_struct('feature', '{c}', 'min_value', CAST(min(`{c}`) AS DOUBLE), "
               f"'max_value', CAST(max(`{c}`) AS DOUBLE), 'mean_value', avg(`{c}`)) AS s{i}")
        for i, c in enumerate(names)
    ])
    rows = stats.select(F.inline(F.array(*stats.columns)))
    return rows.withColumns({
        "only_zeros": F.coalesce((F.col("min_value") == 0) & (F.col("max_value") == 0), F.lit(False)).cast("int"),
        "zero_mean": F.coalesce(F.col("mean_value") == 0, F.lit(False)).cast("int"),
    })


def drop_zero_columns(df: DataFrame, columns: Sequence[str] | None = None,
                      rule: str = "only_zeros") -> DataFrame:
    """Drop numeric columns that hold only zeros.

    ``rule="zero_mean"`` drops a column whose mean is zero instead, which also
    hits columns whose values cancel out. The table is stored first, as it is
    read twice. One row per column reaches the driver, since the columns of a
    DataFrame must be known there.
    """
    if rule not in ("only_zeros", "zero_mean"):
        raise ValueError(f"unknown rule: {rule}")
    df = cut_lineage(df)
    hits = zero_column_report(df, columns).where(F.col(rule) == 1).select("feature").collect()
    return df.drop(*[row["feature"] for row in hits])


def union_zero_fill(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name; a column one side lacks is 0 there.

    Nulls that a side already holds stay null.
    """
    def padded(df: DataFrame, other: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in other.schema}
        lacking = [c for c in other.columns if c not in df.columns]
        return df.withColumns({c: F.lit(0).cast(kinds[c]) for c in lacking}) if lacking else df

    return padded(left, right).unionByName(padded(right, left))
