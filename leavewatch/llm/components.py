"""Connected components of an edge table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.sources.shared_storage import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); the label is the component's least node.

    Each round every node moves to its least neighbour, and edges between
    what has moved together vanish, so that a round at least halves the nodes
    that still have edges. Degrees are reduced on the map side; nothing is
    gathered by component.
    """
    live = cut_lineage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    moved = None  # (node, label so far)
    while True:
        both = live.select(F.col("a").alias("node"), F.col("b").alias("near")).unionByName(live.select(F.col("b").alias("node"), F.col("a").alias("near")))
        step = cut_lineage(both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("to")))
        # Two hops at once: where the least neighbour itself moves.
        hop = step.alias("s").join(step.alias("t"), F.col("s.to") == F.col("t.node"), "left").select(
            F.col("s.node").alias("node"), F.coalesce("t.to", "s.to").alias("to"))
        hop = cut_lineage(hop)
        if moved is None:
            moved = hop.select("node", F.col("to").alias("label"))
        else:
            moved = cut_lineage(moved.join(hop.select(F.col("node").alias("label"), "to"), "label", "left")
                                .select("node", F.coalesce("to", "label").alias("label")))
        one = live.join(hop.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        two = one.join(hop.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        live = cut_lineage(two.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if live.isEmpty():
            return moved
