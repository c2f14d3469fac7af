"""Repeated byte strings, by a distributed merge sort of suffixes that knows common prefixes.

Suffixes that begin at anchors (see windows.py) are sorted: any long enough
repeated string holds an anchor at the same place in each copy. A map task
sorts its suffixes into runs and sends each range of a run front-coded: the
length of the prefix shared with the suffix before, and the bytes after it. A
reducer merges the runs of its range in a loser tree that carries common
prefix lengths: a suffix with the longer prefix in common with the last one
out is the smaller, and only equal lengths are settled by comparing the bytes
after them. Neighbours in the merged order that share the whole sorted depth
are one group, in which equal blocks and repeated windows are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.llm import windows as W
from leavewatch.llm.tables import bodies, restored
from leavewatch.llm.text_arrays import FIRST, SECOND, anchors, covered, mix, slices, spread
from leavewatch.sources.shared_storage import cut_lineage

WINDOW = 100
DEPTH = 24               # bytes of a suffix that are sorted: the anchor itself; whole 8-byte words
BLOCKS_PER_BYTE = 0.027
RANGES = 1024            # ranges of suffixes, at most; more buckets deal each range by a hash
SAMPLE_DOCS, SAMPLE_EACH = 1000, 32  # for the ranges' bounds, which balance the work and decide nothing

_WORDS = DEPTH // 8
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("dup", pa.binary()), ("detail", pa.binary())])


def suffix_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The first DEPTH bytes at each place, as big-endian numbers."""
    raw = data[at[:, None] + np.arange(DEPTH)]
    return np.ascontiguousarray(raw).view(">u8").astype(np.uint64)


def as_bytes(words: np.ndarray) -> np.ndarray:
    return words.astype(">u8").view(np.uint8).reshape(len(words), DEPTH)


def front_coded(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix lengths of a sorted run, and the bytes after them."""
    raw = as_bytes(words)
    same = np.ones((len(raw), DEPTH + 1), dtype=bool)
    same[0] = False
    same[1:, :DEPTH] = raw[1:] == raw[:-1]
    same[:, DEPTH] = False
    shared = same.argmin(axis=1).astype(np.uint8)
    return shared, raw[np.arange(DEPTH) >= shared[:, None]]


def decoded(shared: np.ndarray, rest: np.ndarray) -> np.ndarray:
    raw = np.zeros((len(shared), DEPTH), dtype=np.uint8)
    own = np.arange(DEPTH) >= shared[:, None]
    raw[own] = rest
    row = np.arange(len(shared))
    for c in range(DEPTH):
        raw[:, c] = raw[np.maximum.accumulate(np.where(own[:, c], row, 0)), c]
    return raw.view(">u8").astype(np.uint64)


def merged(runs: list[np.ndarray], shared: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs: the run of each suffix in order, and the prefix it shares with the one before.

    A loser tree with a leaf per run. `common[r]` is what run r's head shares
    with the last suffix out: after an output, that is the run's own front
    code. An ended run has -1 and loses to all. Equal suffixes keep the runs'
    order.
    """
    k = 1
    while k < len(runs):
        k *= 2
    heads = [run.tolist() for run in runs] + [[] for _ in range(k - len(runs))]
    codes = [c.tolist() for c in shared] + [[] for _ in range(k - len(runs))]
    size = [len(h) for h in heads]
    place = [0] * k
    common = [0 if n else -1 for n in size]
    current = [h[0] if h else None for h in heads]
    out_run, out_common = [], []

    def match(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs with one common length."""
        x, y, i = current[a], current[b], common[a] >> 3  # whole words before it are known to be equal
        while i < _WORDS and x[i] == y[i]:
            i += 1
        if i == _WORDS:
            common[max(a, b)] = DEPTH
            return (a, b) if a < b else (b, a)
        length = 8 * i + 8 - (((x[i] ^ y[i]).bit_length() + 7) >> 3)
        won, lost = (a, b) if x[i] < y[i] else (b, a)
        common[lost] = length
        return won, lost

    loser = [0] * k
    champion = list(range(k)) + [0] * 0
    level, base = champion, k // 2
    while len(level) > 1:
        up = []
        for j in range(0, len(level), 2):
            a, b = level[j], level[j + 1]
            if common[a] == common[b]:
                won, lost = match(a, b) if common[a] >= 0 else (a, b)
            else:
                won, lost = (a, b) if common[a] > common[b] else (b, a)
            loser[base + j // 2] = lost
            up.append(won)
        level, base = up, base // 2
    winner = level[0]
    while common[winner] >= 0:
        out_run.append(winner)
        out_common.append(common[winner])
        i = place[winner] + 1
        place[winner] = i
        if i < size[winner]:
            current[winner] = heads[winner][i]
            known = codes[winner][i]
        else:
            known = -1
        common[winner] = known
        node = (winner + k) >> 1
        while node:
            other = loser[node]
            held = common[other]
            if held > known:
                loser[node], winner, known = winner, other, held
            elif held == known and known >= 0:
                won, lost = match(winner, other)
                loser[node], winner = lost, won
            node >>= 1
    return np.array(out_run, dtype=np.int64), np.array(out_common, dtype=np.int64)


def range_bounds(body: DataFrame, ranges: int) -> np.ndarray:
    """Bounds of suffix ranges of about equal size, from a bounded sample."""
    if ranges < 2:
        return np.empty((0,), dtype=f"S{DEPTH}")
    every = max(1, body.count() // SAMPLE_DOCS)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in slices(batch.column(0)):
                at, _, _, text = anchors(data, offsets, WINDOW, DEPTH)
                first = np.searchsorted(text, text)
                count = np.bincount(text, minlength=1)[text] if len(text) else text
                at = at[(np.arange(len(at)) - first) % np.maximum(count // SAMPLE_EACH, 1) == 0]
                at = at[:SAMPLE_EACH * max(1, len(offsets) - 1)]
                raw = as_bytes(suffix_words(data, at))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in raw], pa.binary())], ["suffix"])

    rows = body.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(every)) == 0).select("text").mapInArrow(sample, "suffix binary").toArrow()
    found = np.sort(np.array(rows.column("suffix").to_pylist(), dtype=f"S{DEPTH}"))
    if not len(found):
        return np.empty((0,), dtype=f"S{DEPTH}")
    return np.unique(found[np.arange(1, ranges) * len(found) // ranges])


_MEET, _REPEATED, _LOOK = 0, 1, 2
_RUN = ("u1", "u1", "<u8", "<i8", "<i4", "<i4", "<i4")  # shared, rest, block, doc, lo, n, off
_DECIDED = ("u1", "<i8", "<i4", "<i4", "<i4")           # kind, doc, lo, n, off


def _runs(bounds: np.ndarray, n_ranges: int, each: int):
    """Map side: sorted runs of anchored suffixes, front-coded by bucket."""
    def bucket_of(words: np.ndarray) -> np.ndarray:
        key = np.ascontiguousarray(as_bytes(words)).view(f"S{DEPTH}").reshape(-1)
        part = np.searchsorted(bounds, key, side="right")
        mixed = (words[:, 0] ^ (words[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (words[:, 2] * np.uint64(0xBF58476D1CE4E5B9)))
        return part * each + ((mixed >> np.uint64(20)) % np.uint64(each)).astype(np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            words, block, doc, lo, n, off = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order = np.lexsort(words.T[::-1])
            words, block, doc, lo, n, off = words[order], block[order], doc[order], lo[order], n[order], off[order]
            new = np.ones(len(words), dtype=bool)
            new[1:] = (words[1:] != words[:-1]).any(axis=1)
            group = np.cumsum(new)
            place, dup, _ = W.repeats(group, block, doc, lo, True)
            kind = np.zeros(len(words), dtype=np.uint8)
            kind[place[dup]] = _REPEATED
            rest = np.flatnonzero(kind == _MEET)
            kind[rest[W.hot(group[rest])]] = _LOOK
            run, done = np.flatnonzero(kind == _MEET), np.flatnonzero(kind != _MEET)
            run_bucket = bucket_of(words[run])
            done_bucket = (doc[done].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(n_ranges * each)
            run = run[np.argsort(run_bucket, kind="stable")]
            done = done[np.argsort(done_bucket, kind="stable")]
            run_bucket, done_bucket = np.sort(run_bucket), np.sort(done_bucket.astype(np.int64))
            names = np.unique(np.concatenate([run_bucket, done_bucket]))
            values = []
            for a, b, c, d in zip(np.searchsorted(run_bucket, names), np.searchsorted(run_bucket, names, side="right"),
                                  np.searchsorted(done_bucket, names), np.searchsorted(done_bucket, names, side="right")):
                r, s = run[a:b], done[c:d]
                coded = front_coded(words[r]) if len(r) else (np.empty(0, np.uint8),) * 2
                values.append(W.packed(*coded, block[r], doc[r], lo[r], n[r], off[r], kind[s], doc[s], lo[s], n[s], off[s]))
            return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(values, pa.binary())], ["bucket", "payload"])

        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, last, data, offsets in slices(batch.column(1)):
                at, low, high, text = anchors(data, offsets, WINDOW, DEPTH)
                if not len(at):
                    continue
                block = SECOND.ranges(SECOND.sums(data), low, high + WINDOW)
                held.append((suffix_words(data, at), block, ids[first:last][text], (low - offsets[text]).astype(np.int32),
                             (high - low + 1).astype(np.int32), (at - low).astype(np.int32)))
                if sum(len(h[1]) for h in held) >= W.FLUSH:
                    yield flush()
        if held:
            yield flush()
    return emit


def _merge(hot_group: int):
    """Reduce side: merge a bucket's runs, then judge the blocks of each group of equal suffixes."""
    return lambda table: _merged(table, hot_group)


def _merged(table: pa.Table, hot_group: int) -> pa.Table:
    parts = [W.unpacked(v.as_py(), *_RUN, *_DECIDED) for v in table.column("payload")]
    shared = [p[0] for p in parts]
    run, common = merged([decoded(p[0], p[1]) for p in parts], shared)
    group = np.empty(len(run), dtype=np.int64)
    group[...] = np.cumsum(common < DEPTH)[np.argsort(run, kind="stable")]
    block, doc, lo, n, off = (np.concatenate([p[i] for p in parts]) for i in range(2, 7))
    dup, detail = W.judged(group, block, doc, lo, True)
    kind, doc2, lo2, n2, off2 = (np.concatenate([p[i] for p in parts]) for i in range(7, 12))
    rep, look = kind == _REPEATED, kind == _LOOK
    # A group of which some blocks skipped the meeting has more than HOT here, so it is hot on both ways.
    hot = np.bincount(group[detail], minlength=int(group.max()) + 1)[group] > min(hot_group, W.HOT - 1) if len(group) else np.zeros(0, bool)
    off, off2 = off + W.HOT_MARK * hot, off2 + W.HOT_MARK * look
    out = W.verdicts(*(np.concatenate([a[dup], b[rep]]) for a, b in ((doc, doc2), (lo, lo2), (n, n2))),
                     *(np.concatenate([a[detail], b[look]]) for a, b in ((doc, doc2), (lo, lo2), (n, n2), (off, off2))))
    return pa.Table.from_batches([out] if out else [], _SCHEMA)


_ASKED = ("<i8", "<i4", "<i4", "u1",      # whole blocks: doc, lo, n, bytes
          "<u8", "<u8", "<i8", "<i4",       # windows of hot anchors: two hashes, doc, place
          "<i8", "<i4")                     # windows known to be repeated: doc, place


def _strings(n_buckets: int):
    """Blocks to be looked at, as bytes, dealt by their anchors; those of hot anchors by window, dealt by the windows' hashes."""
    def to(key: np.ndarray) -> np.ndarray:
        """Scrambled first: anchors are where a hash is least, so hashes of theirs are small."""
        return ((mix(key) >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, wanted in W.batches_by_document(batches, W.DETAIL):
            ids = np.asarray(batch.column("doc_id"))
            for first, last, data, offsets in slices(batch.column("text")):
                want = np.concatenate(wanted[first:last])
                if not len(want):
                    continue
                of = np.repeat(np.arange(last - first), [len(w) for w in wanted[first:last]])
                low, n = offsets[of] + want["lo"], want["n"].astype(np.int64)
                at = low + want["off"] % W.HOT_MARK
                sums = FIRST.sums(data)
                key, doc = FIRST.ranges(sums, at, at + DEPTH), ids[first:last][of]
                hot = want["off"] >= W.HOT_MARK
                cold = np.flatnonzero(~hot)
                start = spread(low[hot], n[hot])
                one = FIRST.ranges(sums, start, start + WINDOW)
                two = SECOND.ranges(SECOND.sums(data), start, start + WINDOW) if len(start) else one
                text = np.repeat(of[hot], n[hot])
                whose, place = ids[first:last][text], (start - offsets[text]).astype(np.int32)
                # Of windows that are equal here only the first can be new.
                order = np.lexsort((place, whose, two, one))
                again = np.zeros(len(order), dtype=bool)
                again[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
                sent, known = order[~again], order[again]
                blocks = [doc[cold], want["lo"][cold], want["n"][cold], lambda own: data[spread(low[cold[own]], n[cold[own]] + WINDOW - 1)]]
                out = W.by_bucket((to(key[cold]), blocks), (to(one[sent]), [one[sent], two[sent], whose[sent], place[sent]]),
                                  (whose[known] % n_buckets, [whose[known], place[known]]))
                if out:
                    yield out
    return emit


def _compare(table: pa.Table) -> pa.Table:
    """Windows of a bucket that stand earlier in another block, by two independent hashes."""
    parts = [W.unpacked(v.as_py(), *_ASKED) for v in table.column("payload")]
    total = sum(int(p[2].sum()) + len(p[4]) for p in parts)
    passes = max(1, -(-total // W.AT_ONCE))
    out = [W.runs(np.concatenate([p[8] for p in parts]), np.concatenate([p[9] for p in parts]).astype(np.int64))]
    for turn in range(passes):  # equal windows are in one turn
        columns = []
        for doc, lo, n, raw, one, two, whose, place, _, _ in parts:
            size = n.astype(np.int64)
            begin = np.cumsum(size + WINDOW - 1) - (size + WINDOW - 1)
            start = spread(begin, size)
            first = FIRST.ranges(FIRST.sums(raw), start, start + WINDOW)
            own = np.flatnonzero(first % np.uint64(passes) == turn)
            second = SECOND.ranges(SECOND.sums(raw), start[own], start[own] + WINDOW)
            columns.append((first[own], second, np.repeat(doc, n)[own], spread(lo.astype(np.int64), size)[own]))
            own = np.flatnonzero(one % np.uint64(passes) == turn)
            columns.append((one[own], two[own], whose[own], place[own].astype(np.int64)))
        one, two, doc, place = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((place, doc, two, one))
        again = np.zeros(len(order), dtype=bool)
        again[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        out.append(W.runs(doc[order][again], place[order][again]))
    d, p, n = (np.concatenate(c) for c in zip(*out))
    none = np.empty(0, np.int64)
    batch = W.verdicts(d, p, n, none, none, none, none)
    return pa.Table.from_batches([batch] if batch else [], _SCHEMA)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept {kept}"


def _kept(digest: bool):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, dups in W.batches_by_document(batches, W.DUP):
            for first, last, data, offsets in slices(batch.column("text")):
                of = np.repeat(np.arange(last - first), [len(d) for d in dups[first:last]])
                found = np.concatenate(dups[first:last])
                low = offsets[of] + found["lo"]
                gone = covered(len(data), low, low + found["n"] + WINDOW - 1)
                removed, spans, kept = [], [], []
                for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    cut = gone[a:z]
                    lost = int(cut.sum())
                    raw = (data[a:z][~cut] if lost else data[a:z]).tobytes()
                    removed.append(lost)
                    spans.append(int(cut[0]) + int((cut[1:] > cut[:-1]).sum()) if lost else 0)
                    kept.append(hashlib.sha256(raw).hexdigest() if digest else raw)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
                                                  pa.array(spans, pa.int64()), pa.array(kept, pa.string() if digest else pa.binary())],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return emit


def deduplicated(docs: DataFrame, digest: bool = False, hot_group: int = W.HOT_GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each byte gone that a repeated string of WINDOW bytes covers.

    A string repeats if it also starts in a document of smaller doc_id, or
    earlier in its own; all are judged on the input and may overlap. `kept` is
    the bytes that stay (a cut may split a character), with `digest` their
    SHA-256. A null text is empty; texts shorter than a string are never
    touched; rows that repeat a doc_id are one document (tables.one_per_id; by
    tables.each_row every row is judged); other columns are not read.
    """
    body = bodies(docs)
    n = W.buckets(body, BLOCKS_PER_BYTE)
    bounds = range_bounds(body, min(n, RANGES))
    ranges = len(bounds) + 1
    each = -(-n // ranges)
    sent = body.mapInArrow(_runs(bounds, ranges, each), "bucket int, payload binary")
    found = cut_lineage(W.dealt(sent, n).applyInArrow(_merge(hot_group), W.VERDICT))
    asked = W.joined_spans(body, found, "detail", "inner").mapInArrow(_strings(ranges * each), "bucket int, payload binary")
    more = W.dealt(asked, n).applyInArrow(_compare, W.VERDICT)
    dups = found.select("doc_id", "dup").unionByName(more.select("doc_id", "dup"))
    out = W.joined_spans(body, dups, "dup", "left").mapInArrow(_kept(digest), RESULT.format(kept="string" if digest else "binary"))
    return out.select(restored(), "n_bytes", "n_removed", "n_spans", "kept")
