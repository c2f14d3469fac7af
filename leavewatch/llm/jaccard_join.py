"""Near duplicates by word shingles: a MinHash forest for candidates, exact Jaccard for links.

Texts with equal shingle sets are one class. Each class has a signature of
minimum hashes, and in each of TREES trees a sequence of LONGEST of them. The
sequences of a tree are sorted, so that classes with a common prefix stand
together: a prefix trie. Matched prefixes are shortened from the whole sequence
until every link of the classes below is met with the target recall. How far
depends on what they hold: a set of n shingles can only have some similarities
at the threshold or above (7 shingles: 6/7 or 7/8, never 0.8), and those with
no such similarity take no part. The least of them says which prefix is short
enough for the class (prefix_limits); a node is as long as its least class
allows, and at worst as long as pairs at the threshold need (prefix_length, 8).
A node that falls into more than CROWD longer ones in a task is cut to that at
once, which adds candidates and loses none.

Candidates never become pairs of rows: a node links its members to its least
one, what hangs together is an island, and an island's shingle sets meet in
one task, or, beyond a size, in tiles of two shards each. There links are
found by counting common shingles, so they are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, comb, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.llm import windows as W
from leavewatch.llm.components import components
from leavewatch.llm.tables import bodies, one_per_id, restored
from leavewatch.llm.text_arrays import FIRST, SECOND, byte_set, hashes, mix, slices, spans, spread
from leavewatch.sources.shared_storage import cut_lineage

SHINGLE = 5
THRESHOLD = 0.8
TARGET = 0.9995
HASHES = 192
TREES = 64
LONGEST = 16         # hashes in a tree's sequence
SMALL = 64           # shingles beyond which a set may have any similarity
CROWD = 16           # longer nodes of one prefix in a task
SHARD = 1024         # classes of a large island per shard; a tile holds two shards
SHARD_ITEMS = 1 << 21  # and shingles, on average: sets of long texts make more shards

_WORD = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U64 = np.uint64
_TIMES = mix(np.arange(HASHES, dtype=_U64)) | _U64(1)
_PLUS = mix(np.arange(HASHES, dtype=_U64) + _U64(1 << 32))
_SEQUENCES = np.argsort(mix(np.arange(TREES * HASHES, dtype=_U64) + _U64(1 << 40)).reshape(TREES, HASHES), axis=1)[:, :LONGEST]


def prefix_length(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """The longest prefix with which pairs at the threshold meet often enough.

    Trees share hashes, so the chance is taken over how many of a pair's
    hashes agree.
    """
    agree = [comb(HASHES, k) * threshold**k * (1 - threshold) ** (HASHES - k) for k in range(HASHES + 1)]
    length = LONGEST
    while length > 1:
        if sum(p * (1 - (1 - (k / HASHES) ** length) ** TREES) for k, p in enumerate(agree)) >= target:
            break
        length -= 1
    return length


def least_similarity(n: int, threshold: float = THRESHOLD) -> float | None:
    """The least similarity, of the threshold or more, that a set of n shingles has with some other set; None if there is none."""
    found = []
    for m in range(max(1, ceil(threshold * n - 1e-9)), floor(n / threshold + 1e-9) + 1):
        shared = ceil(threshold * (n + m) / (1 + threshold) - 1e-9)
        if shared <= min(n, m) and not shared == n == m:
            found.append(shared / (n + m - shared))
    return min(found, default=None)


@lru_cache
def prefix_limits(threshold: float = THRESHOLD, target: float = TARGET) -> tuple[int, ...]:
    """By number of shingles, up to SMALL or more, the longest prefix that is short enough; LONGEST + 1 if no other set is near."""
    least = prefix_length(threshold, target)
    out = [least]
    for n in range(1, SMALL):
        similarity = least_similarity(n, threshold) if threshold > 0.1 else threshold
        out.append(LONGEST + 1 if similarity is None else min(prefix_length(similarity, target), least + _DEEPER))
    return (*out, least)


def shingles(column: pa.Array) -> Iterator[tuple]:
    """(first row, row after the last, shingle hashes without repeats, their bounds by row, ascending in each row).

    Words are runs of letters a-z, digits and bytes above 127, in lower-case
    ASCII. A text of fewer words than a shingle has one shingle, of all of them.
    """
    for first, last, data, offsets in slices(column):
        data = _LOWER[data]
        begin, end = spans(data, offsets, _WORD)
        words = hashes(data, begin, end, FIRST)
        count = np.bincount(np.searchsorted(offsets, begin, side="right") - 1, minlength=last - first)
        own = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
        start = spread(np.cumsum(count) - count, own)
        text = np.repeat(np.arange(last - first), own)
        sums = SECOND.sums(words)
        value = SECOND.ranges(sums, start, start + np.minimum(count, SHINGLE)[text])
        order = np.lexsort((value, text))
        text, value = text[order], value[order]
        new = np.ones(len(value), dtype=bool)
        new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
        text, value = text[new], value[new]
        yield first, last, value, np.searchsorted(text, np.arange(last - first + 1))


SIGNED = "doc_id long, c1 long, c2 long, n int, keys binary, deeper binary"
_DEEPER = 8  # levels below the shortest prefix, a byte each


def _sign(limits: tuple[int, ...]):
    """`keys`: the shortest prefix in each tree, if another set can be near; `deeper`: the levels below it, if they can matter."""
    length, limit_of = limits[-1], np.array(limits)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for first, last, value, bounds in shingles(batch.column(1)):
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                c1 = mix(ids[first:last].astype(_U64))  # without words, a class of its own
                c2 = np.zeros(last - first, dtype=_U64)
                keys = np.zeros((len(some), TREES), dtype=_U64)
                if len(some):
                    edge = bounds[some]
                    c1[some] = np.add.reduceat(mix(value ^ _U64(0x5555555555555555)), edge)
                    c2[some] = np.add.reduceat(mix(value), edge) | _U64(1)
                    signature = np.empty((HASHES, len(some)), dtype=_U64)
                    for k in range(HASHES):
                        signature[k] = np.minimum.reduceat(value * _TIMES[k] + _PLUS[k], edge)
                    for t in range(TREES):
                        key = np.full(len(some), t, dtype=_U64)
                        for k in _SEQUENCES[t, :length]:
                            key = mix(key ^ signature[k])
                        keys[:, t] = key
                packed, below = np.full((2, last - first), None, dtype=object)
                limit = limit_of[np.minimum(n[some], SMALL)]
                near = np.flatnonzero(limit <= LONGEST)
                packed[some[near]] = [row.tobytes() for row in keys[near]]
                long = near[limit[near] > length]
                if len(long):
                    path = np.zeros((len(long), TREES), dtype=_U64)
                    for t in range(TREES):
                        for level, k in enumerate(_SEQUENCES[t, length:length + _DEEPER]):
                            path[:, t] |= mix(signature[k, long]) >> _U64(56) << _U64(56 - 8 * level)
                    below[some[long]] = [row.tobytes() for row in path]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last]), pa.array(c1.view(np.int64)), pa.array(c2.view(np.int64)),
                                                  pa.array(n.astype(np.int32)), pa.array(packed, pa.binary()), pa.array(below, pa.binary())],
                                                 ["doc_id", "c1", "c2", "n", "keys", "deeper"])
    return emit


def _kept_path(path: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first levels of paths of _DEEPER bytes."""
    rest = (64 - 8 * np.maximum(levels, 1)).astype(_U64)
    return np.where(levels > 0, path >> rest << rest, _U64(0))


def joined_prefixes(key: np.ndarray, path: np.ndarray, levels: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nodes of the trie (key, path, levels, least member), and edges from the other members to it.

    `key` is the shortest prefix, `path` what follows in the sequence, `levels`
    how much of that a member may ask for. Members are sorted by their
    sequence; under each key the prefix is shortened to the least that its
    members ask for, and to the key alone where more than CROWD nodes are left.
    """
    order = np.lexsort((path, key))
    k, p, m, v = key[order], path[order], levels[order].astype(np.int64), node[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(k)))
    low = np.minimum.reduceat(m, start)

    def parted() -> tuple[np.ndarray, np.ndarray]:
        cut = _kept_path(p, np.repeat(low, size))
        split = new.copy()
        split[1:] |= cut[1:] != cut[:-1]
        return cut, split

    cut, split = parted()
    crowded = np.add.reduceat(split.astype(np.int64), start) > CROWD
    if crowded.any():
        low[crowded] = 0
        cut, split = parted()
    at = np.flatnonzero(split)
    head = np.minimum.reduceat(v, at)
    whose = np.repeat(head, np.diff(np.append(at, len(k))))
    edges = np.unique(np.stack([whose, v])[:, whose != v], axis=1)
    return k[at], cut[at], np.repeat(low, size)[at].astype(np.uint8), head, edges[0], edges[1]


def _nodes(n_buckets: int, limits: tuple[int, ...]):
    """Each task sends one row per trie node, and its own edges within nodes."""
    deeper = np.array([min(limit, LONGEST) - limits[-1] for limit in limits], dtype=np.uint8)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            key, path, levels, node, a, b = joined_prefixes(*(np.concatenate(c) for c in zip(*held)))
            held.clear()
            to = ((key >> _U64(32)) * _U64(n_buckets) >> _U64(32)).astype(np.int64)
            own = (mix(b.astype(_U64)) % _U64(n_buckets)).astype(np.int64)
            return W.by_bucket((to, [key, path, levels, node]), (own, [a, b]))

        none = bytes(8 * TREES)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                key = np.frombuffer(b"".join(k.as_py() for k in part.column("keys")), dtype=_U64)
                path = np.frombuffer(b"".join(k.as_py() or none for k in part.column("deeper")), dtype=_U64)
                levels = deeper[np.minimum(np.asarray(part.column("n")), SMALL)]
                held.append((key, path, np.repeat(levels, TREES), np.repeat(np.asarray(part.column("class_id")), TREES)))
                if sum(len(h[0]) for h in held) >= W.FLUSH:
                    yield flush()
        if held:
            yield flush()
    return emit


def _edges(table: pa.Table) -> pa.Table:
    parts = [W.unpacked(v.as_py(), "<u8", "<u8", "u1", "<i8", "<i8", "<i8") for v in table.column("payload")]
    key, path, levels, node, a, b = (np.concatenate(c) for c in zip(*parts))
    if len(key):
        *_, c, d = joined_prefixes(key, path, levels, node)
        a, b = np.concatenate([a, c]), np.concatenate([b, d])
    a, b = np.unique(np.stack([a, b]), axis=1)
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, value, bounds in shingles(batch.column("text")):
            part = batch.slice(first, last - first)
            raw = [value[a:z].tobytes() for a, z in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column("island"), part.column("tiles"), part.column("shard"), part.column("doc_id"), pa.array(raw, pa.binary())],
                                             ["island", "tiles", "shard", "doc_id", "items"])


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets have in common."""
    out = np.zeros((len(left), len(right)), dtype=np.int32)
    row = np.repeat(np.arange(len(left)), [len(x) for x in left])
    col = np.repeat(np.arange(len(right)), [len(x) for x in right])
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    if not len(both):
        return out
    keep_a, keep_b = np.isin(a, both), np.isin(b, both)
    ia, row = np.searchsorted(both, a[keep_a]), row[keep_a]
    ib, col = np.searchsorted(both, b[keep_b]), col[keep_b]
    na, nb = np.bincount(ia, minlength=len(both)), np.bincount(ib, minlength=len(both))
    dense = np.flatnonzero(na * nb > 4 * (len(left) + len(right)))
    place = np.full(len(both), -1)
    place[dense] = np.arange(len(dense))
    for at in range(0, len(dense), 2048):  # frequent shingles by matrix products
        def block(i: np.ndarray, r: np.ndarray, n: int) -> np.ndarray:
            p = place[i] - at
            own = (place[i] >= at) & (p < 2048)
            m = np.zeros((n, min(2048, len(dense) - at)), dtype=np.float32)
            m[r[own], p[own]] = 1
            return m
        out += (block(ia, row, len(left)) @ block(ib, col, len(right)).T).astype(np.int32)
    rare_a, rare_b = place[ia] < 0, place[ib] < 0  # the others by their pairs
    ia, row = ia[rare_a], row[rare_a]
    order = np.argsort(ib[rare_b], kind="stable")
    ib, col = ib[rare_b][order], col[rare_b][order]
    begin, n = np.searchsorted(ib, ia), nb[ia]
    for at in range(0, len(ia), 1 << 16):
        s = slice(at, at + (1 << 16))
        pairs = np.repeat(row[s].astype(np.int64), n[s]) * len(right) + col[spread(begin[s], n[s])]
        out += np.bincount(pairs, minlength=out.size).reshape(out.shape).astype(np.int32) if len(pairs) > out.size // 8 else _scattered(pairs, out)
    return out


def _scattered(pairs: np.ndarray, like: np.ndarray) -> np.ndarray:
    where, n = np.unique(pairs, return_counts=True)
    out = np.zeros(like.size, dtype=np.int32)
    out[where] = n
    return out.reshape(like.shape)


LINKS = "doc_id long, n_links long, joined long"


def _verify(threshold: float, step: int):
    """Links of a tile: of each class how many, and the least class it hangs together with."""
    def verify(table: pa.Table) -> pa.Table:
        ids, shard = np.asarray(table.column("doc_id")), np.asarray(table.column("shard"))
        sets = [np.frombuffer(v.as_py(), dtype=_U64) for v in table.column("items")]
        order = np.lexsort((ids, shard))
        ids, shard, sets = ids[order], shard[order], [sets[i] for i in order]
        size = np.array([len(s) for s in sets])
        n_links, label = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
        crossing = len(np.unique(shard)) > 1
        first = int((shard == shard[0]).sum()) if crossing else len(ids)
        rows = range(0, first, step)
        right = np.arange(first, len(ids)) if crossing else np.arange(len(ids))
        linked = []
        for at in rows:
            left = np.arange(at, min(at + step, first))
            shared = common([sets[i] for i in left], [sets[i] for i in right])
            near = shared >= threshold * (size[left][:, None] + size[right] - shared) - 1e-9
            if not crossing:
                near &= left[:, None] != right
            n_links[left] += near.sum(axis=1)
            if crossing:
                n_links[right] += near.sum(axis=0)
            i, j = np.nonzero(near)
            linked.append((left[i], right[j]))
        a, b = (np.concatenate(x) for x in zip(*linked))
        while True:  # least label over links
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        return pa.table({"doc_id": pa.array(ids), "n_links": pa.array(n_links), "joined": pa.array(ids[label])})
    return verify


def similar(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET, shard: int = SHARD,
            shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, class_id, class_size, n_links, group_id) of every document.

    class_id is the least doc_id with the same shingles, n_links the number
    of other classes whose Jaccard similarity reaches the threshold, group_id
    the least doc_id that links lead to. A document without words, or null,
    is a class and a group of its own without links. Rows that repeat a
    doc_id are one document (tables.one_per_id; by tables.each_row every row
    is judged, and classes and groups whose first rows repeat a doc_id bear the
    same id); other columns are not read.
    """
    body = bodies(docs)
    limits = prefix_limits(threshold, target)
    signed = cut_lineage(body.mapInArrow(_sign(limits), SIGNED))
    by_class = signed.groupBy("c1", "c2").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"),
                                              *(F.first(c).alias(c) for c in ("n", "keys", "deeper")))
    classes = cut_lineage(by_class)
    size = classes.count()
    n = max(1, -(-size * TREES // W.BUCKET_BLOCKS))
    sent = classes.where("keys is not null").select("class_id", "n", "keys", "deeper").mapInArrow(_nodes(n, limits), "bucket int, payload binary")
    edges = W.dealt(sent, n).applyInArrow(_edges, "a long, b long")
    islands = components(edges)
    sized = islands.join(classes.select(F.col("class_id").alias("node"), "n"), "node")
    counted = sized.groupBy("label").agg(F.count("*").alias("held"), F.sum("n").alias("items"))
    many = (F.col("held") > 2 * shard) | (F.col("items") > 2 * shard_items)
    wanted = F.greatest(F.ceil(F.col("held") / shard), F.least(F.ceil(F.col("items") / shard_items), "held"))
    shards = F.when(many, wanted).otherwise(1).cast("int")
    dealt = (islands.join(counted, "label").withColumn("shards", shards)
             .withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int")))
    tiles = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: F.least(s, "shard") * F.col("shards") + F.greatest(s, "shard"))
    dealt = dealt.select(F.col("node").alias("doc_id"), F.col("label").alias("island"), "shard", tiles.alias("tiles"))
    # The classes in islands follow the input; texts are never sent to where they are.
    sets = (body.join(dealt.hint("merge"), "doc_id").select("island", "tiles", "shard", "doc_id", "text")
            .mapInArrow(_sets, "island long, tiles array<int>, shard int, doc_id long, items binary")
            .select("island", F.explode("tiles").alias("tile"), "shard", "doc_id", "items"))
    found = cut_lineage(sets.groupBy("island", "tile").applyInArrow(_verify(threshold, max(1, shard // 4)), LINKS))
    joined = components(found.select(F.col("doc_id").alias("a"), F.col("joined").alias("b")))
    links = (found.groupBy("doc_id").agg(F.sum("n_links").alias("n_links"))
             .join(joined.select(F.col("node").alias("doc_id"), "label"), "doc_id", "left").withColumnRenamed("doc_id", "class_id"))
    per_class = classes.select("c1", "c2", "class_id", "class_size").join(links, "class_id", "left")
    out = signed.select("doc_id", "c1", "c2").join(per_class, ["c1", "c2"])
    return out.select(restored(), restored("class_id").alias("class_id"), "class_size", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                      restored_or("label", "class_id").alias("group_id"))


def restored_or(column: str, other: str):
    value = F.coalesce(column, other)
    return F.when(value != F.lit(-(1 << 63)), value)


def one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose doc_id is their group's; all columns as they were."""
    stay = similar(docs, threshold).where(F.col("doc_id").eqNullSafe(F.col("group_id"))).select(F.col("doc_id").alias("_stays"))
    kept = one_per_id(docs)
    return (kept.join(stay.select(F.coalesce("_stays", F.lit(-(1 << 63))).alias("doc_id")), "doc_id", "left_semi")
            .withColumn("doc_id", restored()).select(*(F.col(f"`{c}`") for c in docs.columns)))
