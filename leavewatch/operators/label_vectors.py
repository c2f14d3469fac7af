"""Label means as sparse vectors: one entry per label a user has, however many labels there are."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from leavewatch.operators.encoding import label_counts, label_index
from leavewatch.sources.shared_storage import cut_lineage

SPARSE = 0  # a vector's type, as the vector type stores it


def stored_index(log: DataFrame, column: str) -> DataFrame:
    """(label, label_rank) of a column's labels, most frequent first, ties by name; stored."""
    return cut_lineage(label_index(label_counts(log, [column])).select("label", "label_rank"))


def label_mean_vectors(log: DataFrame, column: str, index: DataFrame | None = None, name: str = "labels",
                       size: int | None = None) -> DataFrame:
    """(userId, vector): mean events per session by label, at the label's rank.

    Events are counted by user and label, labels are joined as ranks, and a
    user's entries become one sparse vector: no column, constant or driver row
    per label. ``index`` holds (label, label_rank), the log's own labels by
    default; other labels are left out. A null label counts nowhere. A user
    without any gets an empty vector. ``size`` is that of the vectors, one
    more than the largest rank by default. A user holds one entry per label,
    and fits a task as long as the labels do.
    """
    index = stored_index(log, column) if index is None else index
    if size is None:
        size = (index.agg(F.max("label_rank")).head()[0] or 0) + 1
    sessions = (log.select("userId", "sessionId").distinct().groupBy("userId").agg(F.count("sessionId").alias("n_sessions")))
    counted = (log.where(F.col(column).isNotNull()).groupBy("userId", F.col(column).cast("string").alias("label"))
               .agg(F.count(F.lit(1)).alias("n")))
    entries = (counted.join(index.select("label", "label_rank"), "label").groupBy("userId")
               .agg(F.sort_array(F.collect_list(F.struct("label_rank", "n"))).alias("entries")))
    values = F.transform("entries", lambda e: e["n"] / F.col("n_sessions"))
    rows = sessions.join(entries, "userId", "left").select(
        "userId", F.coalesce(F.col("entries.label_rank").cast("array<int>"), F.array().cast("array<int>")).alias("i"),
        F.coalesce(values, F.array().cast("array<double>")).alias("v"))

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            kind, sizes = pa.array(np.full(n, SPARSE, np.int8)), pa.array(np.full(n, size, np.int32))
            vector = pa.StructArray.from_arrays([kind, sizes, batch.column(1), batch.column(2)], ["type", "size", "indices", "values"])
            yield pa.RecordBatch.from_arrays([batch.column(0), vector], ["userId", name])

    schema = T.StructType([log.schema["userId"], T.StructField(name, VectorUDT())])
    return rows.mapInArrow(wrap, schema)


def vector_entries(df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
    """(keep.., place, value): the long form of sparse vectors, one row per stored entry."""
    def unwrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            indices, values = column.field("indices"), column.field("values")
            lengths = np.asarray(pc.fill_null(pc.list_value_length(indices), 0))
            rows = pa.array(np.repeat(np.arange(batch.num_rows), lengths))
            kept = [batch.column(i).take(rows) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, indices.flatten(), values.flatten()], [*keep, "place", "value"])

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("place", T.IntegerType()), T.StructField("value", T.DoubleType())])
    return df.select(*keep, vector).mapInArrow(unwrap, schema)


def assembled_with(features: DataFrame, vectors: DataFrame, columns: Sequence[str], size: int, vector: str = "labels",
                   output: str = "features") -> DataFrame:
    """The user table with one model input: the columns, then the sparse vector of the same user."""
    joined = features.join(vectors, "userId")
    stages = [VectorSizeHint(inputCol=vector, size=size, handleInvalid="error"),
              VectorAssembler(inputCols=[*columns, vector], outputCol=output)]
    return Pipeline(stages=stages).fit(joined).transform(joined).drop(vector)
