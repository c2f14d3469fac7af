"""Ranks of labels that stay as the log grows.

An encoding fitted on one chunk has to hold for the next. The dictionary only
grows: a label gets its rank when it is first seen, behind all that were there,
most frequent in that chunk first, ties by name. Ranks never move; counts are
kept by chunk and add up. A chunk that comes again under its name changes
nothing. Two writers cannot give one rank twice: the one who is second to swap
the manifest ranks anew behind the labels of the first.

New labels are found by an anti-join and numbered by a range-partitioned sort,
so there may be any number. The driver sees the number of labels per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.operators.encoding import label_counts
from leavewatch.operators.ranking import with_position
from leavewatch.sources.manifest import Manifest, State
from leavewatch.sources.shared_storage import cut_lineage

LABELS = "column string, label string, label_rank long, added_in string"
COUNTS = "column string, label string, n_events long"


class LabelDictionary:
    """(column, label, label_rank, added_in, n_events) below a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.manifest = spark, Manifest(spark, path)

    def _read(self, folders: Sequence[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.manifest.full(f) for f in folders])

    def add_chunk(self, name: str, log: DataFrame, columns: Sequence[str] = tuple(fixed.ENCODED_COLUMNS),
                  clean_agents: bool = False) -> bool:
        """Count the labels of a chunk and rank the new ones; False if a chunk of that name is there."""
        if name in self.manifest.read()[1].get("counts", {}):
            return False
        counts_folder = self.manifest.fresh_folder("counts")
        label_counts(log, columns, clean_agents).select("column", "label", "n_events").write.parquet(
            self.manifest.full(counts_folder))
        counts = self._read([counts_folder], COUNTS)
        added = False

        def grow(state: State) -> State | None:
            nonlocal added
            known = state.get("counts", {})
            if name in known:
                added = False
                return None
            sizes = state.get("sizes", {})
            old = self._read(state.get("labels", []), LABELS)
            new = cut_lineage(counts.join(old, ["column", "label"], "left_anti"))
            per_column = {r["column"]: r["count"] for r in new.groupBy("column").count().collect()}
            grown = {"counts": known | {name: counts_folder}, "labels": state.get("labels", []),
                     "sizes": {c: sizes.get(c, 0) + per_column.get(c, 0) for c in {*sizes, *per_column}}}
            if per_column:
                placed = with_position(new, "column", F.desc("n_events"), "label")
                before, base = 0, []
                for column in sorted(per_column, key=str.encode):
                    base.append((column, sizes.get(column, 0) - before))
                    before += per_column[column]
                starts = F.broadcast(self.spark.createDataFrame(base, "column string, base long"))  # a row per column
                folder = self.manifest.fresh_folder("labels")
                (placed.join(starts, "column")
                 .select("column", "label", (F.col("position") + F.col("base")).alias("label_rank"), F.lit(name).alias("added_in"))
                 .write.parquet(self.manifest.full(folder)))
                grown["labels"] = grown["labels"] + [folder]
            added = True
            return grown

        self.manifest.change(grow)
        return added

    def read(self) -> DataFrame:
        """Every label with its rank, the chunk that brought it, and its count over all chunks."""
        _, state = self.manifest.read()
        labels = self._read(state.get("labels", []), LABELS)
        folders = list(state.get("counts", {}).values())
        counts = self._read(folders, COUNTS).groupBy("column", "label").agg(F.sum("n_events").alias("n_events"))
        return labels.join(counts, ["column", "label"])

    def encoded(self, df: DataFrame, column: str) -> DataFrame:
        """The rows with ``<column>_rank``: null for a null or unknown label."""
        ranks = self.read().where(F.col("column") == column).select(
            F.col("label").alias("_label"), F.col("label_rank").alias(f"{column}_rank"))
        return df.join(ranks, F.col(column).cast("string") == F.col("_label"), "left").drop("_label")

