"""Exact top-k inner products by a dual walk over two cover trees.

Queries are dealt to blocks of bounded size; a block goes to all tasks. Each
task builds cover trees over its slices of the vectors and over the block, and
walks both together: a pair of nodes is dropped when no vector below one can
reach, with any query below the other, the worst kth score found so far in
that query group. Each slice returns k rows per query at most, which Spark
merges. Scores are exact integers; bounds are rounded outwards.

A child's covering radius is its parent's divided by BASE at most, and centers
of one parent are further apart than that. How much is pruned is up to the
data: vectors in clusters leave few pairs of nodes, vectors spread evenly over
a sphere of many dimensions leave them all (`Search.scored` counts).

Nulls: see top_k; ties go to the smaller vec_id; an empty table, or one without
queries, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TOP = 5
EVERY = 50            # queries are the rows whose vec_id is divisible by this
SCALE = 256.0
QUERY_BLOCK = 4096    # queries sent to all tasks at once
SLICE_ROWS = 20_000   # vectors in one tree
BASE = 1.3            # a level's covering radius over the next one's
LEAF, LEAST_EACH = 64, 8              # rows of a node that stays whole; rows per child, on average, below which a node does
QUERY_LEAF, QUERY_LEAST_EACH = 4, 2   # the same for queries: tight groups prune
_EXACT = 1 << 53


def quantized(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that take part, and their vectors as integers by dimension.

    Null vectors and those that hold null, NaN or infinity take no part, nor
    do empty ones.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.cast(column, pa.list_(pa.float64()))
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0))
    flat = column.flatten()  # leaves out null lists
    values = np.asarray(pc.fill_null(flat, np.nan), dtype=np.float64) if len(flat) else np.empty(0)
    begin = np.cumsum(lengths) - lengths
    finite = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = (lengths > 0) & (finite[begin + lengths] == finite[begin])
    return np.flatnonzero(good), [np.floor(SCALE * values[b:b + n]) for b, n in zip(begin[good], lengths[good])]


@dataclass
class Node:
    center: np.ndarray
    norm: float
    radius: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(vectors: np.ndarray, leaf: int = LEAF, least_each: int = LEAST_EACH, rows: np.ndarray | None = None) -> Node:
    """A node's children cover its rows within radius / BASE of their centers, which are further apart than that.

    Nodes of ``leaf`` rows stay whole, and so do those whose rows lie so far
    apart that children would hold ``least_each`` each or fewer.
    """
    rows = np.arange(len(vectors)) if rows is None else rows
    own = vectors[rows]
    center = own[0]
    distance = np.sqrt(((own - center) ** 2).sum(axis=1))
    radius = float(distance.max())
    node = Node(center, float(np.sqrt((center ** 2).sum())), radius, rows, [])
    if len(rows) <= leaf or radius == 0:
        return node
    nearest, of, centers = distance, np.zeros(len(rows), dtype=np.int64), [0]
    while nearest[far := int(nearest.argmax())] > radius / BASE:
        if least_each * len(centers) >= len(rows):
            return node
        d = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
        closer = d < nearest
        of[closer] = len(centers)
        centers.append(far)
        nearest = np.minimum(nearest, d)
    for c, head in enumerate(centers):
        part = np.flatnonzero(of == c)
        if len(part):  # a vector equal to an earlier center has gone to it
            node.children.append(cover_tree(vectors, leaf, least_each, rows[np.concatenate([[head], part[part != head]])]))
    return node


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products; exact in double precision while below 2**53, else by Python's integers."""
    limit = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * queries.shape[1]
    if limit < _EXACT:
        return (queries @ vectors.T).astype(np.int64)
    whole = [[int(x) for x in v] for v in vectors]
    return np.array([[sum(a * b for a, b in zip(map(int, q), v)) for v in whole] for q in queries], dtype=object)


class Search:
    """Best k of one slice of vectors for each query of a block."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int):
        self.queries, self.query_ids, self.vectors, self.ids, self.k = queries, query_ids, vectors, ids, k
        self.best = [[] for _ in queries]                  # (-score, vec_id), ascending
        self.worst = np.full(len(queries), -np.inf)        # kth score
        self.scored = 0                                    # pairs

    def ceiling(self, q: Node, v: Node) -> float:
        bound = float(q.center @ v.center) + q.norm * v.radius + v.norm * q.radius + q.radius * v.radius
        return bound + 1e-9 * (abs(bound) + (q.norm + q.radius) * (v.norm + v.radius)) + 1e-6

    def walk(self, q: Node, v: Node) -> None:
        if self.ceiling(q, v) < self.worst[q.rows].min():
            return
        if not q.children and not v.children:
            return self.leaves(q, v)
        if q.children and (not v.children or q.radius > v.radius):
            for child in q.children:
                self.walk(child, v)
            return
        for _, _, child in sorted(((-self.ceiling(q, c), i, c) for i, c in enumerate(v.children)), key=lambda x: x[:2]):
            self.walk(q, child)

    def leaves(self, q: Node, v: Node) -> None:
        scores = products(self.queries[q.rows], self.vectors[v.rows])
        self.scored += scores.size
        ids = self.ids[v.rows]
        hit = scores >= self.worst[q.rows][:, None]  # ties may still win by id
        for i in np.flatnonzero(hit.any(axis=1)).tolist():
            of = int(q.rows[i])
            near = np.flatnonzero(hit[i] & (ids != self.query_ids[of]))
            near = near[np.lexsort((ids[near], -scores[i, near]))[:self.k]]
            best = sorted(self.best[of] + [(-int(scores[i, j]), int(ids[j])) for j in near.tolist()])[:self.k]
            self.best[of] = best
            if len(best) == self.k:
                self.worst[of] = -best[-1][0]


def distinct_vectors(vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors the k + 1 with the least ids: of more, none can be among a query's k best."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    v = vectors[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (v[1:] != v[:-1]).any(axis=1)
    start = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
    keep = order[rank <= k]
    return vectors[keep], ids[keep]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores over all vectors but those with its own id.

    Both tables have vec_id and embedding; other columns are not read. Ties go
    to the smaller vec_id. Rows with a null id take no part; rows that repeat
    are candidates each. Only vectors of a query's length are its candidates.
    Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    stated = queries.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    blocks = max(1, -(-stated.count() // query_block))
    found = None
    for b in range(blocks):
        rows = stated.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()  # about query_block rows
        part, values = quantized(rows.column("embedding"))
        ids = np.asarray(rows.column("vec_id"))[part] if len(part) else np.empty(0, np.int64)
        groups = {}
        for n in sorted({len(v) for v in values}):
            of = [i for i, v in enumerate(values) if len(v) == n]
            groups[n] = (np.stack([values[i] for i in of]), ids[of])
        sent = spark.sparkContext.broadcast(groups)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            trees = {n: cover_tree(q, QUERY_LEAF, QUERY_LEAST_EACH) for n, (q, _) in sent.value.items()}
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    piece = batch.slice(at, SLICE_ROWS)
                    rows, values = quantized(piece.column(1))
                    known = np.asarray(piece.column(0))[rows] if len(rows) else np.empty(0, np.int64)
                    size = np.array([len(v) for v in values])
                    out = []
                    for n, (q, q_ids) in sent.value.items():
                        of = np.flatnonzero(size == n)
                        if len(of):
                            own, own_ids = distinct_vectors(np.stack([values[i] for i in of]), known[of], k)
                            s = Search(q, q_ids, own, own_ids, k)
                            s.walk(trees[n], cover_tree(own))
                            out += [(int(q_ids[i]), v, -score) for i, best in enumerate(s.best) for score, v in best]
                    if out:
                        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

        part = (vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
                .mapInArrow(search, "query_id long, vec_id long, score long"))
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def stated_queries(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    return vectors.where(F.col("vec_id") % every == 0)
