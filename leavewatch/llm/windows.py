"""What both substring operators share: windows of a text that occur earlier, found without shuffling every window.

A text is a sequence of items (words or bytes). Every window of items has an
anchor (text_arrays.anchors), and equal windows have equal anchors at the same
place. A run of windows with one anchor is a block; only blocks are exchanged:
a key made of the anchor, a hash of the block, and where it stands.

* Blocks with one key and hash are equal. All but the first repeat it: every
  window in them is repeated. Copies inside one map task are resolved before
  the exchange, so a passage in a third of all documents arrives once per task.
* Distinct blocks with one key may share windows. The first copy of each is
  looked at window by window, among the blocks of its key. Where a key has more
  than HOT_GROUP of them it is hot: its windows are dealt by their own hash, so
  that no task gets more of them than another.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

FLUSH = 400_000       # blocks a map task gathers before it sends them
BUCKET_BLOCKS = 250_000
HOT = 4096            # blocks of one key in one task beyond which they skip the meeting by key
HOT_GROUP = 1024      # blocks of one key to be looked at beyond which their windows are dealt one by one
HOT_MARK = 1 << 16    # added to the anchor's place in a block of a hot key
AT_ONCE = 2_000_000   # windows compared at once

DUP = np.dtype([("lo", "<i4"), ("n", "<i4")])
DETAIL = np.dtype([("lo", "<i4"), ("n", "<i4"), ("off", "<i4")])
VERDICT = "doc_id long, dup binary, detail binary"

_codec = pa.Codec("zstd", compression_level=1)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value."""
    parts = []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        small = _codec.compress(raw, asbytes=True) if raw else b""
        parts.append(struct.pack("<qq", len(raw), len(small)) + small)
    return b"".join(parts)


def unpacked(value: bytes, *kinds) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds:
        size, small = struct.unpack_from("<qq", value, at)
        at += 16
        raw = _codec.decompress(value[at:at + small], size, asbytes=True) if size else b""
        out.append(np.frombuffer(raw, dtype=kind))
        at += small
    return out


def buckets(docs: DataFrame, per_item: float) -> int:
    """How many parts the exchanges have: so many that each holds about BUCKET_BLOCKS; `per_item` is blocks per byte."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return max(1, -(-int(size * per_item) // BUCKET_BLOCKS), min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(size) >> 20))


def dealt(sent: DataFrame, n: int) -> GroupedData:
    """Rows by bucket, in n partitions: packed values are small, and merging partitions by their size would leave few tasks."""
    return sent.repartition(n, "bucket").groupBy("bucket")


def repeats(group: np.ndarray, block: np.ndarray, doc: np.ndarray, lo: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (group, block, doc, place), which of those repeat an earlier equal block, and each block's begin.

    With `within`, an earlier place of the same document counts; else only a smaller doc_id.
    """
    order = np.lexsort((lo, doc, block, group))
    g, b, d = group[order], block[order], doc[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (b[1:] != b[:-1])
    if within:
        return order, ~new, new
    start = np.flatnonzero(new)
    first = np.repeat(d[start], np.diff(np.append(start, len(order))))
    return order, d > first, new


def judged(group: np.ndarray, block: np.ndarray, doc: np.ndarray, lo: np.ndarray, within: bool,
           crowded: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Masks over the rows: windows all repeated; first copies to be looked at because their group has other blocks.

    The first copies of a group with a `crowded` row are looked at in any
    case: some of its blocks skipped the meeting, and may be copies of them.
    """
    order, dup, new = repeats(group, block, doc, lo, within)
    g = group[order]
    start = np.ones(len(order), dtype=bool)
    start[1:] = g[1:] != g[:-1]
    at = np.flatnonzero(start)
    kinds = np.add.reduceat(new.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
    several = kinds > 1
    if crowded is not None and len(at):
        several |= np.logical_or.reduceat(crowded[order], at)
    several = np.repeat(several, np.diff(np.append(at, len(order))))
    out = np.zeros((2, len(order)), dtype=bool)
    out[0, order], out[1, order] = dup, several & ~dup
    return out[0], out[1]


def hot(group: np.ndarray) -> np.ndarray:
    """Rows beyond the first HOT of a group."""
    order = np.argsort(group, kind="stable")
    g = group[order]
    start = np.flatnonzero(np.diff(g, prepend=g[:1] ^ g.dtype.type(1))) if len(g) else np.empty(0, np.int64)
    rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
    out = np.zeros(len(g), dtype=bool)
    out[order] = rank >= HOT
    return out


def by_document(doc: np.ndarray, dup: np.ndarray, detail: np.ndarray) -> pa.RecordBatch | None:
    """VERDICT rows: one per document, of its DUP and DETAIL records. `doc` is of both, dup first."""
    if not len(doc):
        return None
    names = np.unique(doc)

    def column(records: np.ndarray, of: np.ndarray) -> pa.Array:
        order = np.argsort(of, kind="stable")
        count = np.bincount(np.searchsorted(names, of), minlength=len(names))
        ends = np.concatenate([[0], np.cumsum(count * records.dtype.itemsize)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(names), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(records[order].tobytes())])

    return pa.RecordBatch.from_arrays([pa.array(names), column(dup, doc[:len(dup)]), column(detail, doc[len(dup):])], ["doc_id", "dup", "detail"])


def records(kind: np.dtype, **columns: np.ndarray) -> np.ndarray:
    out = np.empty(len(next(iter(columns.values()))), dtype=kind)
    for name, values in columns.items():
        out[name] = values
    return out


def verdicts(dup_doc, dup_lo, dup_n, det_doc, det_lo, det_n, det_off) -> pa.RecordBatch | None:
    return by_document(np.concatenate([dup_doc, det_doc]).astype(np.int64), records(DUP, lo=dup_lo, n=dup_n),
                       records(DETAIL, lo=det_lo, n=det_n, off=det_off))


def gathered(spans: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    """Per row, the records of a column array<binary>."""
    return [np.frombuffer(b"".join(v.as_py() for v in row), dtype=kind) if (row := cell.values) is not None and len(row) else np.empty(0, kind)
            for cell in spans]


def runs(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive places of a document, sorted, as (doc, begin, count)."""
    order = np.lexsort((place, doc))
    d, p = doc[order], place[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)
    start = np.flatnonzero(new)
    return d[start], p[start], np.diff(np.append(start, len(d)))


def by_bucket(*groups: tuple[np.ndarray, list[np.ndarray]]) -> pa.RecordBatch | None:
    """Rows (bucket, payload) of several groups of arrays, each dealt by its own buckets; a payload has the arrays of all groups."""
    order = [np.argsort(bucket, kind="stable") for bucket, _ in groups]
    buckets = [bucket[o] for (bucket, _), o in zip(groups, order)]
    names = np.unique(np.concatenate(buckets))
    if not len(names):
        return None
    left, right = ([np.searchsorted(b, names, side=side) for b in buckets] for side in ("left", "right"))
    values = []
    for k in range(len(names)):
        arrays = []
        for (_, columns), o, a, z in zip(groups, order, left, right):
            own = o[a[k]:z[k]]
            arrays += [c(own) if callable(c) else c[own] for c in columns]
        values.append(packed(*arrays))
    return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(values, pa.binary())], ["bucket", "payload"])


def joined_spans(body: DataFrame, spans: DataFrame, column: str, how: str) -> DataFrame:
    """body with `spans`, the list of a document's records; at most one element per bucket and source."""
    listed = spans.where(F.octet_length(column) > 0).groupBy("doc_id").agg(F.collect_list(column).alias("spans"))
    return body.join(listed, "doc_id", how)


def batches_by_document(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        yield batch, gathered(batch.column("spans"), kind)
