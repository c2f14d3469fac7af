"""Benchmark passages in training documents, by suffix arrays of the documents.

Each slice of documents is a shard with a suffix array over its words. Every
suffix of every benchmark item is looked up by binary search in each shard;
its range in the array gives all places that share the item's next words. The
benchmark is the stated query set: it goes to all tasks in blocks of bounded
size, the documents are scanned in place and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leavewatch.llm.tables import NO_ID, row_struct, row_text, with_row, without_text
from leavewatch.llm.text_arrays import FIRST, SECOND, byte_set, hashes, slices, spans, spread
from leavewatch.sources.shared_storage import cut_lineage

WINDOW = 10
BLOCK_BYTES = 16 << 20   # of benchmark text sent to all tasks at once
SHARD_BYTES = 2 << 20    # of document text in one suffix array

_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_END, _OTHER, _KNOWN = 0, 1, 2  # ranks: after the text, a word of no item, the first item word


def _words(column: pa.Array, limit: int) -> Iterator[tuple]:
    for first, last, data, offsets in slices(column, limit):
        data = _LOWER[data]
        begin, end = spans(data, offsets, _WORD)
        count = np.bincount(np.searchsorted(offsets, begin, side="right") - 1, minlength=last - first)
        yield first, last, hashes(data, begin, end, FIRST), hashes(data, begin, end, SECOND), count


@dataclass
class Suffixes:
    """A block of benchmark items: their distinct windows in order, and where each occurs."""

    known: np.ndarray     # first hashes of the item words, ascending
    second: np.ndarray
    low: np.ndarray       # windows as keys, ascending
    high: np.ndarray
    length: np.ndarray    # words in each
    begin: np.ndarray     # of each window's occurrences below
    count: np.ndarray
    item: np.ndarray      # item_id of each occurrence
    place: np.ndarray     # its first word
    whole: np.ndarray     # number of the item, so that items with one id are apart
    width: int

    @classmethod
    def of(cls, rows: list[Row], width: int) -> Suffixes:
        texts = pa.array([r["text"] or "" for r in rows], pa.string())
        parts = list(_words(texts, 1 << 62))
        _, _, h1, h2, count = parts[0] if parts else (0, 0, np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64))
        known, at = np.unique(h1, return_index=True)
        rank = (np.searchsorted(known, h1) + _KNOWN).astype(np.uint32)
        own = np.where(count >= width, count - width + 1, np.minimum(count, 1))  # windows of each item
        begin = np.cumsum(count) - count
        start = spread(begin, own)
        length = np.repeat(np.minimum(count, width), own)
        item = np.repeat(np.arange(len(count)), own)
        step = np.arange(width)
        inside = step < length[:, None]
        words = np.where(inside, rank[np.minimum(start[:, None] + step, max(len(rank) - 1, 0))] if len(rank) else 0, _END).astype(">u4")
        top = np.where(inside, words, np.uint32(0xFFFFFFFF)).astype(">u4")
        kind = f"S{4 * width}"
        keys = np.ascontiguousarray(words).view(kind).reshape(-1)
        tops = np.ascontiguousarray(top).view(kind).reshape(-1)
        order = np.lexsort((length, keys))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (length[order][1:] != length[order][:-1])
        first = np.flatnonzero(new)
        ids = np.array([r["item_id"] if r["item_id"] is not None else NO_ID for r in rows], dtype=np.int64)
        return cls(known, h2[at], keys[order][first], tops[order][first], length[order][first], first,
                   np.diff(np.append(first, len(order))), ids[item[order]] if len(order) else np.empty(0, np.int64),
                   (start - begin[item])[order], item[order], width)

    def ranks(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.full(len(h1), _OTHER, dtype=np.uint32)
        at = np.minimum(np.searchsorted(self.known, h1), len(self.known) - 1)
        return np.where((self.known[at] == h1) & (self.second[at] == h2), at + _KNOWN, _OTHER).astype(np.uint32)

    def matches(self, rank: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, word) of every occurrence of a window in a shard's texts."""
        if not len(self.low) or not len(rank):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lead = self.low.view(">u4").reshape(-1, self.width)
        end = np.repeat(np.cumsum(count), count)
        follow = np.where(np.arange(len(rank)) + 1 < end, np.append(rank[1:], _END), _END).astype(np.uint64)
        # A suffix that begins with no window's first words cannot match; the array holds the others.
        pair = (rank.astype(np.uint64) << np.uint64(32)) | follow
        single = np.zeros(int(max(rank.max(), lead[:, 0].max())) + 1, dtype=bool)
        single[lead[self.length == 1, 0]] = True
        two = np.unique((lead[self.length > 1, 0].astype(np.uint64) << np.uint64(32)) | lead[self.length > 1, min(1, self.width - 1)])
        near = np.flatnonzero(rank >= _KNOWN)
        at = np.minimum(np.searchsorted(two, pair[near]), max(len(two) - 1, 0))
        start = near[((two[at] == pair[near]) if len(two) else False) | single[rank[near]]]
        if not len(start):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        step = start[:, None] + np.arange(self.width)
        words = np.where(step < end[start][:, None], rank[np.minimum(step, len(rank) - 1)], _END).astype(">u4")
        keys = words.view(self.low.dtype).reshape(-1)
        order = np.argsort(keys, kind="stable")
        suffixes = keys[order]
        left = np.searchsorted(suffixes, self.low, side="left")
        size = np.searchsorted(suffixes, self.high, side="right") - left
        found = np.flatnonzero(size > 0)
        return np.repeat(found, size[found]), start[order[spread(left[found], size[found])]]


RESULT = ("n_words long, hit array<int>, items array<string>, longest struct<words:int, item_id:long, at:int>")


def _length(match: dict | None) -> tuple:
    """Orders matches of a text: longer first, then earlier in the text, then of a smaller item."""
    return (match["words"], -match["at"], -(NO_ID if match["item_id"] is None else match["item_id"])) if match else (0, 0, 0)


def _shard(index: Suffixes, h1, h2, count) -> tuple[list, list, list]:
    """Hit words, items and longest verbatim match of each text."""
    window, word = index.matches(index.ranks(h1, h2), count)
    n = len(count)
    hits, items, longest = [[] for _ in range(n)], [[] for _ in range(n)], [None] * n
    if not len(window):
        return hits, items, longest
    begin = np.cumsum(count) - count
    text = np.searchsorted(np.cumsum(count), word, side="right")
    covered = np.unique(spread(word, index.length[window]))
    of = np.searchsorted(np.cumsum(count), covered, side="right")
    edge = np.flatnonzero(np.diff(of, prepend=-1))
    for a, b in zip(edge.tolist(), np.append(edge[1:], len(of)).tolist()):
        hits[of[a]] = (covered[a:b] - begin[of[a]]).tolist()
    # Occurrences of a window in the items; neighbours on one diagonal are one longer match.
    each = np.repeat(np.arange(len(window)), index.count[window])
    occurrence = spread(index.begin[window], index.count[window])
    whole, place = index.whole[occurrence], index.place[occurrence]
    w, t = word[each], text[each]
    order = np.lexsort((w, w - place, whole, t))
    run = np.ones(len(order), dtype=bool)
    a, b = order[1:], order[:-1]
    run[1:] = (w[a] != w[b] + 1) | (place[a] != place[b] + 1) | (whole[a] != whole[b]) | (t[a] != t[b])
    start = np.flatnonzero(run)
    last = np.append(start[1:], len(order)) - 1
    size = last - start + index.length[window[each[order[start]]]]
    # The longest is set last; of equal ones the first in the text, then that of the smallest item.
    for i in np.lexsort((-index.item[occurrence[order[start]]], -w[order[start]], size)).tolist():
        o = order[start[i]]
        item = int(index.item[occurrence[o]])
        longest[t[o]] = {"words": int(size[i]), "item_id": None if item == NO_ID else item, "at": int(w[o] - begin[t[o]])}
    pairs = np.unique(np.stack([t, whole]), axis=1)
    ids = dict(zip(index.whole.tolist(), index.item.tolist()))
    for i, k in pairs.T.tolist():
        items[i].append("null" if ids[k] == NO_ID else str(ids[k]))
    return hits, items, longest


def matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, keep: list[str] | None = None,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The kept columns of every row as struct `row`, and RESULT beside it.

    A null or empty text has no words and is never hit. Items without words,
    null ones too, match nothing; items with a null id are one item, "null".
    Items that repeat an id are one item; items that repeat are dropped first.
    Rows that repeat are judged alike. Of longest matches the
    first in the text counts, then that of the smallest item, null before all. Empty tables give empty results, or no hits. A
    document's words have to fit in a task, and are held as hashes there.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    held = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(held) // block_bytes))
    columns = keep if keep is not None else docs.columns
    kept, inside = row_struct(docs, columns)
    state = docs.select(kept)
    result = ["n_words", "hit", "items", "longest"]
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about block_bytes
        index = spark.sparkContext.broadcast(Suffixes.of(rows, window))
        last = b == blocks - 1

        def scan(batches: Iterator[pa.RecordBatch], index=index, more=b > 0, last=last) -> Iterator[pa.RecordBatch]:
            suffixes = index.value
            for batch in batches:
                for first, stop, h1, h2, count in _words(row_text(batch.column(0), inside), SHARD_BYTES):
                    hits, found, longest = _shard(suffixes, h1, h2, count)
                    part = batch.slice(first, stop - first)
                    if more:
                        hits = [sorted({*x, *y}) for x, y in zip(hits, part.column("hit").to_pylist())]
                        found = [x + y for x, y in zip(found, part.column("items").to_pylist())]
                        longest = [max((y, x), key=_length) for x, y in zip(longest, part.column("longest").to_pylist())]
                    row = part.column(0)
                    if last and not inside:
                        row = without_text(row)
                    arrays = [row, pa.array(count.astype(np.int64)), pa.array(hits, pa.list_(pa.int32())),
                              pa.array(found, pa.list_(pa.string())),
                              pa.array(longest, pa.struct([("words", pa.int32()), ("item_id", pa.int64()), ("at", pa.int32())]))]
                    yield pa.RecordBatch.from_arrays(arrays, ["row", *result])

        schema = with_row(docs, columns, RESULT)
        if not last:
            schema = T.StructType([state.schema["row"], *schema.fields[1:]])
        state = state.mapInArrow(scan, schema)
        if not last:
            state = cut_lineage(state)
    return state


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, hit words, items, digest of the items' ids, longest match, whether contaminated."""
    ids = F.array_distinct(F.array_sort("items"))
    found = matched(docs, benchmark, window, ["doc_id"])
    return found.select("row.doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.size("hit") > 0).alias("contaminated"),
                        F.col("longest.words").alias("longest_words"), F.col("longest.item_id").alias("longest_item"),
                        F.col("longest.at").alias("longest_at"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any window of an item, all columns as they were."""
    return matched(docs, benchmark, window).where(F.size("hit") == 0).select("row.*")
