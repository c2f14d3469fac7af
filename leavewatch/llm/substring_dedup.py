"""Repeated passages of words, by parsing documents against reference blocks.

Passages are dealt by their anchors (see windows.py). What meets in one bucket
of anchors is a reference block: the passages around its anchors, indexed by
their windows. A document's passages go to every reference block that can
hold a match of theirs, and no other can. Equal passages are settled by their
hash, as factors that are a whole passage. The others are parsed greedily
(relative Lempel-Ziv): from where the last factor ended, the longest match in
a passage of a smaller doc_id is the next factor. Letters of the parse are
windows, so a factor has WINDOW words at least, and the window that crosses a
factor's end is the first that is looked up after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leavewatch.llm import windows as W
from leavewatch.llm.tables import bodies, restored
from leavewatch.llm.text_arrays import FIRST, SECOND, anchors, byte_set, covered, hashes, mix, slices, spans, spread
from leavewatch.sources.shared_storage import cut_lineage

WINDOW = 13
GRAM = 5
BLOCKS_PER_BYTE = 0.035

_WORD = ~byte_set((0x20, 0x20), (0x09, 0x0D))


def _words(column: pa.Array) -> Iterator[tuple]:
    """Word begins and ends, hashes, and the texts' bounds in them."""
    for first, last, data, offsets in slices(column):
        begin, end = spans(data, offsets, _WORD)
        count = np.bincount(np.searchsorted(offsets, begin, side="right") - 1, minlength=last - first)
        yield first, last, data, begin, end, hashes(data, begin, end), np.concatenate([[0], np.cumsum(count)])


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    """Scrambled first: anchors are where a hash is least, so hashes of theirs are small."""
    return ((mix(key) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _send(kind: np.ndarray, columns: list[np.ndarray], bucket: np.ndarray) -> pa.RecordBatch:
    """One row per bucket: its rows' columns, packed; `kind` of each comes first."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    start = np.flatnonzero(np.diff(b, prepend=-1))
    columns = [kind[order], *(c[order] for c in columns)]
    values = [W.packed(*(c[a:z] for c in columns)) for a, z in zip(start, np.append(start[1:], len(b)))]
    return pa.RecordBatch.from_arrays([pa.array(b[start].astype(np.int32)), pa.array(values, pa.binary())], ["bucket", "payload"])


_KINDS = ("u1", "<u8", "<u8", "<i8", "<i4", "<i4", "<i4")  # resolved or not, key, block, doc, lo, n, off
_MEET, _REPEATED, _LOOK, _CROWDED = 0, 1, 2, 3  # _CROWDED: meets, and other blocks of its key are _LOOK


def _blocks(window: int, gram: int, n_buckets: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            key, block, doc, lo, n, off = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order, dup, _ = W.repeats(key, block, doc, lo, False)
            kind = np.zeros(len(key), dtype=np.uint8)
            kind[order[dup]] = _REPEATED
            rest = np.flatnonzero(kind == _MEET)
            look = W.hot(key[rest])
            kind[rest[np.isin(key[rest], key[rest[look]])]] = _CROWDED
            kind[rest[look]] = _LOOK
            # What is decided travels with the document, not with a key that may be hot.
            to = np.where((kind == _MEET) | (kind == _CROWDED), key, doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            return _send(kind, [key, block, doc, lo, n, off], _bucket(to, n_buckets))

        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, last, _, _, _, words, bounds in _words(batch.column(1)):
                at, low, high, text = anchors(words, bounds, window, gram)
                key = FIRST.ranges(FIRST.sums(words), at, at + gram)
                block = SECOND.ranges(SECOND.sums(words), low, high + window)
                held.append((key, block, ids[first:last][text], (low - bounds[text]).astype(np.int32), (high - low + 1).astype(np.int32),
                             (at - low).astype(np.int32)))
                if sum(len(h[0]) for h in held) >= W.FLUSH:
                    yield flush()
        if held and any(len(h[0]) for h in held):
            yield flush()
    return emit


def _meet(hot_group: int):
    return lambda table: _met(table, hot_group)


def _met(table: pa.Table, hot_group: int) -> pa.Table:
    parts = [W.unpacked(v.as_py(), *_KINDS) for v in table.column("payload")]
    kind, key, block, doc, lo, n, off = (np.concatenate(c) for c in zip(*parts))
    meet = np.flatnonzero((kind == _MEET) | (kind == _CROWDED))
    dup, detail = (meet[m] for m in W.judged(key[meet], block[meet], doc[meet], lo[meet], False, kind[meet] == _CROWDED))
    # A key is hot with many blocks to be looked at, or with some that skipped the meeting; those know it themselves.
    names, of = np.unique(key, return_inverse=True)
    hot = (np.bincount(of[detail], minlength=len(names)) > hot_group) | (np.bincount(of[kind == _CROWDED], minlength=len(names)) > 0)
    look = np.flatnonzero(kind == _LOOK)
    off = np.concatenate([off[detail] + W.HOT_MARK * hot[of[detail]], off[look] + W.HOT_MARK])
    dup = np.concatenate([dup, np.flatnonzero(kind == _REPEATED)])
    detail = np.concatenate([detail, look])
    out = W.verdicts(doc[dup], lo[dup], n[dup], doc[detail], lo[detail], n[detail], off)
    return pa.Table.from_batches([out] if out else [], pa.schema([("doc_id", pa.int64()), ("dup", pa.binary()), ("detail", pa.binary())]))


_ASKED = ("<i8", "<i4", "<i4", "<u8",    # whole passages: doc, lo, n, hashes of the windows
          "<u8", "<i8", "<i4",             # windows of hot anchors: hash, doc, place
          "<i8", "<i4",                    # windows known to be repeated: doc, place
         "<u8")                           # of the whole passages: key


def _passages(window: int, gram: int, n_buckets: int):
    """Blocks to be looked at, with the hashes of their windows; those of hot anchors by window, dealt by the hashes."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, wanted in W.batches_by_document(batches, W.DETAIL):
            ids = np.asarray(batch.column("doc_id"))
            for first, last, _, _, _, words, bounds in _words(batch.column("text")):
                of = np.repeat(np.arange(last - first), [len(w) for w in wanted[first:last]])
                want = np.concatenate(wanted[first:last])
                if not len(want):
                    continue
                low, n, doc = bounds[of] + want["lo"], want["n"].astype(np.int64), ids[first:last][of]
                at = low + want["off"] % W.HOT_MARK
                key = FIRST.ranges(FIRST.sums(words), at, at + gram)
                sums = SECOND.sums(words)
                hot = want["off"] >= W.HOT_MARK
                cold = np.flatnonzero(~hot)

                def windows_of(own: np.ndarray) -> np.ndarray:
                    start = spread(low[cold[own]], n[cold[own]])
                    return SECOND.ranges(sums, start, start + window)

                start = spread(low[hot], n[hot])
                seen = SECOND.ranges(sums, start, start + window)
                text = np.repeat(of[hot], n[hot])
                whose, place = ids[first:last][text], (start - bounds[text]).astype(np.int32)
                # Of windows that are equal here only those of the first document can be new.
                order = np.lexsort((place, whose, seen))
                new = np.ones(len(order), dtype=bool)
                new[1:] = seen[order][1:] != seen[order][:-1]
                begin = np.flatnonzero(new)
                least = np.repeat(whose[order][begin], np.diff(np.append(begin, len(order))))
                again = whose[order] > least
                sent, known = order[~again], order[again]
                blocks = [doc[cold], want["lo"][cold], want["n"][cold], windows_of]
                out = W.by_bucket((_bucket(key[cold], n_buckets), blocks),
                                  (_bucket(seen[sent], n_buckets), [seen[sent], whose[sent], place[sent]]),
                                  (whose[known] % n_buckets, [whose[known], place[known]]),
                              (_bucket(key[cold], n_buckets), [key[cold]]))
                if out:
                    yield out
    return emit


def longest(seen: np.ndarray, doc: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window the longest match with a smaller doc: how many windows from it on, and where the first such match begins.

    Windows come passage by passage, sorted by (doc, place); `left` counts
    them to the end of their passage. Groups are nodes of the trie of all
    passages' suffixes: each level adds a window, and only nodes with a match
    are descended.
    """
    length, source = np.zeros(len(seen), dtype=np.int32), np.full(len(seen), -1, dtype=np.int64)
    _, letter = np.unique(seen, return_inverse=True)
    live, node, size = np.arange(len(seen)), letter, 1
    while len(live):
        _, first, node = np.unique(node, return_index=True, return_inverse=True)
        head = live[first][node]  # rows are sorted, so the first of a node is the earliest
        copy = doc[head] < doc[live]
        length[live[copy]], source[live[copy]] = size, head[copy]
        matched = np.zeros(len(first), dtype=bool)
        matched[node[copy]] = True
        go = matched[node] & (left[live] > size)
        live = live[go]
        node = node[go] * len(seen) + letter[live + size]
        size += 1
    return length, source


def factors(doc: np.ndarray, lo: np.ndarray, n: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, ...]:
    """Greedy factors (doc, first window, windows, reference's doc and first window) of passages.

    A passage is n windows of a document from window lo on; `seen` has the
    windows' hashes, passage by passage. Of equally long matches the earliest
    by (doc, place) is the reference.
    """
    order = np.lexsort((lo, doc))
    begin = np.cumsum(n) - n
    seen = seen[spread(begin[order], n[order])]
    doc, lo, n = doc[order], lo[order], n[order]
    end = np.cumsum(n)
    begin = end - n
    where = np.arange(len(seen))
    length, source = longest(seen, np.repeat(doc, n), (np.repeat(end, n) - where).astype(np.int32))
    ahead = np.where(length > 0, where, len(seen))
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]  # the next window with a match
    at, stop, starts = begin, end, []
    while True:  # the next factor of every passage at once
        own = np.flatnonzero(at < stop)
        at, stop = ahead[at[own]], stop[own]
        own = np.flatnonzero(at < stop)
        at, stop = at[own], stop[own]
        if not len(at):
            break
        starts.append(at)
        at = at + length[at]
    at = np.concatenate([np.empty(0, np.int64), *starts])

    def stands(window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        passage = np.searchsorted(end, window, side="right")
        return doc[passage], lo[passage] + window - begin[passage]

    return (*stands(at), length[at].astype(np.int64), *stands(source[at]))


def _factored(table: pa.Table) -> pa.Table:
    schema = pa.schema([("doc_id", pa.int64()), ("dup", pa.binary()), ("detail", pa.binary())])
    parts = [W.unpacked(v.as_py(), *_ASKED) for v in table.column("payload")]
    total = sum(len(p[3]) + len(p[4]) for p in parts)
    passes = max(1, -(-total // W.AT_ONCE))
    out = [W.runs(np.concatenate([p[7] for p in parts]), np.concatenate([p[8] for p in parts]).astype(np.int64))]
    for turn in range(passes):  # passages with one key are in one turn, and windows of hot anchors with one hash
        doc, lo, n, seen = [], [], [], []
        for d, low, count, w, w2, d2, p2, _, _, key in parts:
            count = count.astype(np.int64)
            own = np.flatnonzero(mix(key) % np.uint64(passes) == turn)
            doc.append(d[own])
            lo.append(low[own].astype(np.int64))
            n.append(count[own])
            seen.append(w[spread((np.cumsum(count) - count)[own], count[own])])
            own = np.flatnonzero(w2 % np.uint64(passes) == turn)
            doc.append(d2[own])
            lo.append(p2[own].astype(np.int64))
            n.append(np.ones(len(own), dtype=np.int64))
            seen.append(w2[own])
        out.append(factors(*(np.concatenate(c) for c in (doc, lo, n, seen)))[:3])
    d, p, n = (np.concatenate(c) for c in zip(*out))
    none = np.empty(0, np.int64)
    batch = W.verdicts(d, p, n, none, none, none, none)
    return pa.Table.from_batches([batch] if batch else [], schema)


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def _kept(window: int, digest: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, dups in W.batches_by_document(batches, W.DUP):
            for first, last, data, begin, end, _, bounds in _words(batch.column("text")):
                raw = data.tobytes()
                removed, kept = [], []
                of = np.repeat(np.arange(last - first), [len(d) for d in dups[first:last]])
                spans_ = np.concatenate(dups[first:last])
                low = bounds[of] + spans_["lo"]
                gone = covered(len(begin), low, low + spans_["n"] + window - 1)
                for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    left = np.flatnonzero(~gone[a:z]) + a
                    removed.append(z - a - len(left))
                    text = b" ".join([raw[x:y] for x, y in zip(begin[left].tolist(), end[left].tolist())])
                    kept.append(hashlib.sha256(text).hexdigest() if digest else text.decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(np.diff(bounds)),
                                                  pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])
    return emit


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, digest: bool = False,
                 hot_group: int = W.HOT_GROUP) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each word gone that a repeated window covers.

    A window repeats if its words also follow each other in a document of a
    smaller doc_id; all are judged on the input. Kept words are joined by one
    space (`digest`: the SHA-256 of that). A null text has no words; rows that
    repeat a doc_id are one document (tables.one_per_id; by tables.each_row
    every row is judged); other columns are not read. Texts shorter than a window are never touched.
    """
    body = bodies(docs)
    n = W.buckets(body, BLOCKS_PER_BYTE)
    sent = body.mapInArrow(_blocks(window, gram, n), "bucket int, payload binary")
    found = cut_lineage(W.dealt(sent, n).applyInArrow(_meet(hot_group), W.VERDICT))
    asked = W.joined_spans(body, found, "detail", "inner").mapInArrow(_passages(window, gram, n), "bucket int, payload binary")
    more = W.dealt(asked, n).applyInArrow(_factored, W.VERDICT)
    dups = found.select("doc_id", "dup").unionByName(more.select("doc_id", "dup"))
    out = W.joined_spans(body, dups, "dup", "left").mapInArrow(_kept(window, digest), RESULT)
    return out.select(restored(), "n_words", "n_removed", "kept")
