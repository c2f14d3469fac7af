"""Reading the tables, and what operators keyed by doc_id need of their input."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leavewatch.operators.ranking import with_position

NO_ID = -(1 << 63)  # stands for a null doc_id inside an operator


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def key_column(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id")


def restored(key: str = "doc_id") -> Column:
    """The doc_id behind a key."""
    return F.when(F.col(key) != NO_ID, F.col(key)).alias("doc_id")


def one_per_id(docs: DataFrame) -> DataFrame:
    """All columns, with doc_id as a key and null text as empty; one row per doc_id.

    Of rows that repeat a doc_id the one with the least text stays (then the
    least of the other columns). Whether there are any is one aggregate over
    the ids; only then are texts grouped.
    """
    keyed = docs.withColumns({"doc_id": key_column(), "text": F.coalesce(F.col("text").cast("string"), F.lit(""))})
    repeated = keyed.groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return keyed
    order = ["text"] + [c for c in docs.columns if c not in ("doc_id", "text")]
    least = keyed.groupBy("doc_id").agg(F.min(F.struct(*(F.col(f"`{c}`") for c in order))).alias("row"))
    return least.select("doc_id", "row.*").select(*(F.col(f"`{c}`") for c in docs.columns))


def each_row(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], ids: Iterable[str] = ("doc_id",)) -> DataFrame:
    """operator(docs), with every row a document of its own where doc_ids repeat or are missing.

    Such rows are numbered by doc_id (null first), then a hash of their other
    columns, then where they stood; the operator sees the numbers as doc_ids.
    The columns `ids` of its result, which hold them, become doc_ids again.
    """
    if docs.select(key_column()).groupBy("doc_id").count().where("count > 1").isEmpty():
        return operator(docs)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "doc_id"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_all"), key_column().alias("_place"),
                       F.md5(F.to_json(F.struct(*others))).alias("_hash"), F.monotonically_increasing_id().alias("_among"))
    numbered = with_position(rows, "_place", "_hash", "_among", name="_key")
    # The columns of docs stay inside the struct, so no name of theirs meets one of these.
    out = operator(numbered.select(*(F.col("_key").alias(c) if c == "doc_id" else F.col("_all")[c].alias(c) for c in docs.columns)))
    for name in ids:
        known = numbered.select("_key", F.col("_all")["doc_id"].alias("_own")).alias("known")
        joined = out.alias("found").join(known, F.col(f"found.`{name}`") == F.col("known._key"))
        out = joined.select(*(F.col("known._own").alias(c) if c == name else F.col(f"found.`{c}`") for c in out.columns))
    return out


def bodies(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of one_per_id."""
    return one_per_id(docs.select("doc_id", "text"))


_TEXT = "_text_of_the_row"


def row_struct(docs: DataFrame, columns: list[str]) -> tuple[Column, bool]:
    """The columns as struct `row`, for a pass through Arrow that looks at the text.

    The text goes once: as one of the columns if it is a string there (then
    the second value is True), else as a last one, which without_text drops.
    """
    inside = "text" in columns and docs.schema["text"].dataType.simpleString() == "string"
    more = [] if inside else [F.col("text").cast("string").alias(_TEXT)]
    return F.struct(*(F.col(f"`{c}`") for c in columns), *more).alias("row"), inside


def with_row(docs: DataFrame, columns: list[str], result: str) -> T.StructType:
    """Schema of struct `row` with the columns, and the result's columns beside it."""
    row = T.StructType([docs.schema[c] for c in columns])
    return T.StructType([T.StructField("row", row), *T.StructType.fromDDL(result).fields])


def row_text(row: pa.StructArray, inside: bool) -> pa.Array:
    return row.field("text" if inside else _TEXT)


def without_text(row: pa.StructArray) -> pa.StructArray:
    names = [f.name for f in row.type][:-1]
    return pa.StructArray.from_arrays([row.field(i) for i in range(len(names))], names)
