"""Best-fit packing of documents into sequences, with bounds that certify it.

Pieces are dealt to groups of bounded size, by a number of their own, so that
equal rows spread like others. Each group packs its pieces by best-fit
decreasing and compares the number of its sequences with a lower bound from
dual-feasible functions. Where both are equal the group is certified: no
packing of its pieces has fewer sequences, and all of them stay but the one
that is at most half full, if there is one. Groups with a gap keep their full
sequences alone. What is not kept is exchanged: those pieces are dealt anew,
meet those of other groups, and are packed again by best-fit decreasing, until
one group holds them all or a round makes no fewer sequences of them.

Nulls: a null text is one piece, the end id. Rows that repeat are documents of
their own. Ties in length go by doc_id, then piece. Empty tables give an empty
result. Long texts are cut into pieces where they are encoded; a text and its
ids have to fit in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.llm import tokens
from leavewatch.sources.shared_storage import cut_lineage

CAPACITY = 4096
GROUP = 100_000  # pieces that one task packs, about
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = tokens.END_ID) -> DataFrame:
    """Every document's ids with the end id, cut at the capacity; lengths and check sums only.

    A null text is empty (one piece of the end id). A repeated row is a document of its own.
    """
    where = tokenizer or tokens.tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, ids, offsets in tokens.encoded(batch.column(1), where, end_id):
                length = np.diff(offsets)
                n = -(-length // capacity)
                piece = tokens.spread(np.zeros(len(n), np.int64), n)
                start = piece * capacity
                size = np.minimum(np.repeat(length, n) - start, capacity)
                begin = np.repeat(offsets[:-1], n) + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + s)]) for a, s in zip(begin.tolist(), size.tolist())]
                of = pa.array(np.repeat(np.arange(first, last), n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Fewest sequences any packing needs, at least: the best of two families of dual-feasible functions."""
    count = np.bincount(np.asarray(lengths, dtype=np.int64), minlength=capacity + 1)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    # Sizes above C - k count as C, sizes below k as nothing.
    above = np.cumsum(count[::-1])[::-1]
    weight = np.concatenate([[0], np.cumsum(count * size)])
    for k in range(1, capacity // 2 + 1):
        middle = int(weight[capacity - k + 1] - weight[k])
        large = int(above[capacity - k + 1]) if k >= 1 else 0
        best = max(best, large + -(-middle // capacity))
    # x (k + 1) / C rounded down, over k, unless it is whole.
    for k in range(1, min(100, capacity)):
        times = (k + 1) * size
        scaled = np.where(times % capacity == 0, k * times // (k + 1), (times // capacity) * capacity)  # k times the function's value
        best = max(best, -(-int((count * scaled).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Sequence number of each piece."""
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(lengths), dtype=np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, made = 0, 0  # bit r: some sequence has room r
    for i, need in zip(order.tolist(), lengths[order].tolist()):
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, made
            made += 1
        out[i] = chosen
        left = room - need
        if left:
            if not by_room[left]:
                rooms |= 1 << left
            by_room[left].append(chosen)
    return out


def packed_group(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Sequence and offset of each piece, the group's gap, and whether the sequence stays."""
    frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
    length = frame["length"].to_numpy()
    local = best_fit_decreasing(length, capacity)
    fill = np.bincount(local, weights=length).astype(np.int64)
    order = np.argsort(local, kind="stable")
    running = np.cumsum(length[order]) - length[order]
    begin = np.concatenate([[0], np.cumsum(fill)[:-1]])
    offset = np.empty(len(frame), dtype=np.int64)
    offset[order] = running - begin[local[order]]
    gap = len(fill) - bound(length, capacity)
    stays = fill == capacity if gap else 2 * fill > capacity  # best fit leaves one sequence that is half full or less, at most
    return frame.assign(local=local, offset=offset, stays=stays[local], gap=gap, used=len(fill))


_ROWS = f"{PIECES}, row long"
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]


def dealt(pool: DataFrame, turn: int, groups: int) -> DataFrame:
    """Add grp, by the row's number and the turn."""
    return pool.withColumn("grp", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)).cast("int"))


def packed(parts: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to rows of PIECES.

    sequence_id is unique but not dense. An empty table gives an empty result.
    """
    pool = cut_lineage(parts.select(*_NAMES[:-1]).withColumn("row", F.monotonically_increasing_id()))
    schema = f"{_ROWS}, grp int, local long, offset long, stays boolean, gap long, used long"
    done, turn, left, opened = [], 0, pool.count(), None
    while True:
        groups = max(1, -(-left // group))
        packs = dealt(pool, turn, groups).groupBy("grp").applyInPandas(lambda frame: packed_group(frame, capacity), schema)
        tried = cut_lineage(packs.withColumn("sequence_id", F.lit(turn << 56) + F.col("grp").cast("long") * (1 << 28) + F.col("local")))
        # One row per group: sequences made, and how many of them are open.
        made, closed = tried.groupBy("grp").agg(F.first("used").alias("used"), F.count_distinct(F.when(F.col("stays"), F.col("local"))).alias("closed")).agg(
            F.coalesce(F.sum("used"), F.lit(0)), F.coalesce(F.sum("closed"), F.lit(0))).head()
        # Packing again is over where one group holds all, nothing is open, or the last exchange saved nothing.
        over = groups == 1 or made == closed or (opened is not None and made >= opened)
        done.append((tried if over else tried.where("stays")).select(*_NAMES[:-1], "sequence_id", "offset"))
        if over:
            break
        pool, opened, turn = tried.where("not stays").select(*_NAMES), made - closed, turn + 1
        left = pool.count()
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, group: int = GROUP, tokenizer: str | None = None,
                   end_id: int = tokens.END_ID) -> DataFrame:
    """PIECES of all documents with sequence_id and offset, in few sequences."""
    return packed(pieces(docs, capacity, tokenizer, end_id), capacity, group)


def certificate(out: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """(sequences used, sequences that any packing needs), from one row per length."""
    used = out.agg(F.count_distinct("sequence_id")).first()[0]
    by_length = out.groupBy("length").count().collect()  # at most `capacity` rows
    lengths = np.repeat([r["length"] for r in by_length], [r["count"] for r in by_length]) if by_length else np.empty(0, np.int64)
    return used, bound(lengths, capacity)
