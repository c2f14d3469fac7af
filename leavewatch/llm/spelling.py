"""Spelling variants: words one edit apart, found by Gram matrices of letter-count blocks.

Words are runs of letters, counted over all texts; the contract's query drops a
letter from a few of them first, as its rule says. One edit changes the counts
of two letters at most: the squared distance of the letter counts of two near
words is 2 if they are equally long, and 1 if their lengths differ by one. The
letters are dealt to GROUPS groups of about equal mass, so that near words
agree on all counts of at least GROUPS - 2 groups. For each choice of so many
groups, the words that agree on them are a block. Within a block, sorted by
length, NumPy products of count matrices give the squared distances of words of
the same and of adjacent lengths; pairs at most 2 apart are verified letter by
letter. A pair that meets in several blocks counts in the first. No pair leaves
its task: what goes out is a number and the best partner per word and block.

Blocks are dealt to tasks by their hash. Of a block with more than TILE words
of one length, each length goes out in shards, and tasks take two shards each.

Nulls: a null text has no words; a null doc_id is empty text in the rule. Rows
that repeat count each. Empty texts and tables give no words. Texts of any
length are read whole, piece by piece. Ties between best partners go to the
smallest word in code-point order. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.sources.shared_storage import cut_lineage

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
DROP_EVERY = 31
GROUPS = 4
TILE = 4096            # words of one length in a block, beyond which it is dealt in shards
BUCKET_ROWS = 60_000   # rows of blocks in one task's piece of work
CHUNK = 256            # rows of a product at once
WIDE = 4096            # columns of a product at once
PIECE = 1 << 22        # code points of a text looked at at once
_HELD = 300_000        # words counted in a task before they are handed on

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_LETTERS = "[a-zÀ-ÿ]"
_RUN = re.compile(f"{_LETTERS}+")
_SYMBOLS = 26 + 64
_WEIGHTS = np.random.default_rng(13).integers(1, 1 << 62, _SYMBOLS, dtype=np.int64)
_CHOICES = list(combinations(range(GROUPS), GROUPS - 2))


def lowered(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")


def runs(text: str, least_length: int) -> Iterator[list[str]]:
    """The maximal runs of letters, those long enough, piece by piece."""
    pattern, at = re.compile(f"{_LETTERS}{{{least_length},}}"), 0
    while at < len(text):
        piece = lowered(text[at:at + PIECE])
        at += len(piece)
        # A run that reaches the piece's end goes on in the next one.
        while at < len(text) and (more := _RUN.match(lowered(text[at:at + PIECE]))) and _RUN.match(piece, len(piece) - 1):
            piece += more.group()
            at += more.end()
        yield pattern.findall(piece)


def dropped(doc_id: int | None, run: str) -> str:
    """The run, less one letter where the rule says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DROP_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, rule=dropped) -> DataFrame:
    """(word, n) of the words of all texts, counted in the tasks first.

    ``rule(doc_id, run)`` makes a word of a run, never a longer one.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, own = doc_id.as_py(), Counter()
                for found in runs(text.as_py() or "", least_length):
                    own.update(found)
                for run, n in own.items():
                    if len(word := rule(doc_id, run)) >= least_length:
                        total[word] += n
                if len(total) > _HELD:
                    yield out()
                    total.clear()
        yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.where("text is not null").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points on end, and the length of each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32), lengths


def letter_counts(words: list[str]) -> np.ndarray:
    """A row per word: how often each of the 90 letters stands in it."""
    points, lengths = code_points(words)
    symbol = np.where(points < 128, points.astype(np.int64) - 97, points.astype(np.int64) - 0xC0 + 26)
    flat = np.repeat(np.arange(len(words)) * _SYMBOLS, lengths) + symbol
    return np.bincount(flat, minlength=len(words) * _SYMBOLS).reshape(len(words), _SYMBOLS)


def letter_groups(vocabulary: DataFrame) -> np.ndarray:
    """Group of each letter: the most frequent first, each to the lightest group. Ninety sums reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_SYMBOLS, dtype=np.int64)
        for batch in batches:
            total += letter_counts(batch.column(0).to_pylist()).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_SYMBOLS, dtype=np.int32)), pa.array(total)], ["letter", "n"])

    sums = np.zeros(_SYMBOLS, dtype=np.int64)
    for row in vocabulary.select("word").mapInArrow(count, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        sums[row["letter"]] = row["n"]
    group, load = np.zeros(_SYMBOLS, dtype=np.int64), [0] * GROUPS
    for letter in np.argsort(-sums, kind="stable").tolist():
        lightest = load.index(min(load))
        group[letter] = lightest
        load[lightest] += int(sums[letter])
    return group


def group_hashes(counts: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A row per word: a hash of its counts in each group. Equal for pairs near each other only where the counts are."""
    with np.errstate(over="ignore"):
        return np.stack([counts[:, group == g] @ _WEIGHTS[group == g] for g in range(GROUPS)], axis=1)


def block_keys(hashes: np.ndarray) -> np.ndarray:
    """A row per word: the key of its block for each choice of groups."""
    with np.errstate(over="ignore"):
        return np.stack([sum(hashes[:, g] for g in chosen) * np.int64(6364136223846793005) + np.int64(c)
                         for c, chosen in enumerate(_CHOICES)], axis=1)


def blocks(vocabulary: DataFrame, group: np.ndarray) -> DataFrame:
    """(key, choice, size, word, n): every word in its block for each choice of groups."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, wide = batch.column(0).to_pylist(), len(_CHOICES)
            if not words:
                continue
            keys = block_keys(group_hashes(letter_counts(words), group))
            rows = pa.array(np.repeat(np.arange(len(words)), wide))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys.ravel()), pa.array(np.tile(np.arange(wide, dtype=np.int32), len(words))),
                pa.array(np.repeat(np.fromiter(map(len, words), np.int32, len(words)), wide)),
                batch.column(0).take(rows), batch.column(1).take(rows)], ["key", "choice", "size", "word", "n"])

    return vocabulary.select("word", "n").mapInArrow(place, "key long, choice int, size int, word string, n long")


def one_edit(points: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b), b as long as a or longer by one, differ by exactly one edit. Rows of points are padded with 0."""
    short, wide = points[a], points[b]
    within = np.arange(points.shape[1] - 1) < lengths[a][:, None]
    same = (short[:, :-1] == wide[:, :-1]) | ~within
    equal = lengths[a] == lengths[b]
    replaced = (~same).sum(axis=1) == 1
    head = np.where(same.all(axis=1), lengths[a], same.argmin(axis=1))
    shifted = (short[:, :-1] == wide[:, 1:]) | ~within
    tail_from = np.where(shifted.all(axis=1), 0, shifted.shape[1] - shifted[:, ::-1].argmin(axis=1))
    return np.where(equal, replaced, tail_from <= head)


class Best:
    """Number of near words, and the best of them, per row."""

    def __init__(self, n_rows: int):
        self.near = np.zeros(n_rows, dtype=np.int64)
        self.best = np.full(n_rows, -1, dtype=np.int64)

    def add(self, rows: np.ndarray, partners: np.ndarray, n: np.ndarray, order: np.ndarray) -> None:
        """Partners of rows; the best has the largest n, then the first place in order."""
        if not len(rows):
            return
        self.near += np.bincount(rows, minlength=len(self.near))
        known = self.best >= 0
        rows = np.concatenate([rows, np.flatnonzero(known)])
        partners = np.concatenate([partners, self.best[known]])
        sort = np.lexsort((order[partners], -n[partners], rows))
        rows, partners = rows[sort], partners[sort]
        first = np.ones(len(rows), dtype=bool)
        first[1:] = rows[1:] != rows[:-1]
        self.best[rows[first]] = partners[first]


def near_in_bucket(keys: np.ndarray, choices: np.ndarray, words: list[str], n: np.ndarray, group: np.ndarray,
                   side: np.ndarray | None = None) -> Best:
    """Near words within the blocks of a bucket.

    With ``side``, each key is a tile of a large block: words of side 0 are
    compared with those of side 1 only, words of side 2 with each other.
    """
    flat, lengths = code_points(words)
    by = np.lexsort((lengths, keys))
    at = np.cumsum(lengths) - lengths
    points = np.zeros((len(words), int(lengths.max()) + 1), dtype=np.uint32)
    points[np.repeat(np.arange(len(words)), lengths), np.arange(len(flat)) - np.repeat(at, lengths)] = flat
    counts = letter_counts(words)
    hashes = group_hashes(counts, group)
    order = np.empty(len(words), dtype=np.int64)
    order[np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)] = np.arange(len(words))
    used = counts.any(axis=0)
    left = counts[by][:, used].astype(np.float32)
    square = (left * left).sum(axis=1)
    one = np.ones_like(square)
    # Rows of the products below are the squared distances at once.
    left, right = np.column_stack([-2 * left, square, one]), np.column_stack([left, one, square]).T
    key, length = keys[by], lengths[by]
    # Partners of a row: those behind it in the same block, at most one letter longer.
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (length[1:] != length[:-1])]))
    ends = np.append(starts[1:], len(key))
    run = np.repeat(np.arange(len(starts)), ends - starts)
    after = np.minimum(run + 1, len(starts) - 1)
    longer = (key[starts[after]] == key) & (length[starts[after]] == length + 1)
    end = np.where(longer, ends[after], ends[run])
    best = Best(len(words))
    for a in range(0, len(key), CHUNK):
        b = min(a + CHUNK, len(key))
        top = int(end[a:b].max())
        for c in range(a, top, WIDE):
            d = min(c + WIDE, top)
            i, j = np.nonzero(left[a:b] @ right[:, c:d] < 2.5)
            i, j = i + a, j + c
            keep = (j > i) & (j < end[i])
            i, j = by[i[keep]], by[j[keep]]
            if side is not None:
                keep = (side[i] != side[j]) | (side[i] == 2)
                i, j = i[keep], j[keep]
            keep = one_edit(points, lengths, i, j)
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            agree = hashes[i] == hashes[j]
            first = np.argmax(np.stack([agree[:, chosen].all(axis=1) for chosen in map(list, _CHOICES)], axis=1), axis=1)
            keep = first == choices[i]
            i, j = i[keep], j[keep]
            best.add(np.concatenate([i, j]), np.concatenate([j, i]), n, order)
    return best


def _near_schema() -> str:
    return "word string, n_near long, best_n long, best string"


def _bucket_work(group: np.ndarray, sided: bool):
    def work(table: pa.Table) -> pa.Table:
        words, n = table.column("word").to_pylist(), np.asarray(table.column("n"))
        side = np.asarray(table.column("side")) if sided else None
        best = near_in_bucket(np.asarray(table.column("key")), np.asarray(table.column("choice")), words, n, group, side)
        rows = np.flatnonzero(best.near)
        partner = best.best[rows]
        return pa.table({"word": pa.array([words[i] for i in rows], pa.string()), "n_near": pa.array(best.near[rows]),
                         "best_n": pa.array(n[partner]), "best": pa.array([words[i] for i in partner], pa.string())})

    return work


def near_words(vocabulary: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best) of the words of a stored vocabulary (word, n) that have a near word."""
    group = letter_groups(vocabulary)
    placed = cut_lineage(blocks(vocabulary, group))
    large = (placed.groupBy("key", "size").count().groupBy("key").agg(F.max("count").alias("most"))
             .where(F.col("most") > tile).select("key", F.ceil(F.col("most") / tile).cast("int").alias("shards")))
    large = cut_lineage(large)
    whole, found = placed, None
    if not large.isEmpty():
        whole = placed.join(large.select("key"), "key", "left_anti")
        found = _near_in_tiles(placed.join(large, "key"), group)
    buckets = max(1, -(-placed.count() // BUCKET_ROWS))
    dealt = whole.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    near = dealt.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_bucket_work(group, False), _near_schema())
    near = near if found is None else near.unionByName(found)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    return (near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("first"))
            .select("word", "n_near", (-F.col("first.less")).alias("best_n"), F.col("first.best").alias("best")))


def _near_in_tiles(rows: DataFrame, group: np.ndarray) -> DataFrame:
    """The same for words of large blocks, (.., shards): a word meets each shard of its own and of the next length in a tile of its own."""
    shard = F.pmod(F.xxhash64("word"), F.col("shards")).cast("int")
    sharded = rows.withColumn("shard", shard)

    def tile(size, low, high, side):
        return F.struct(F.xxhash64("key", size, low, high).alias("tile"), side.alias("side"))

    every = F.sequence(F.lit(0), F.col("shards") - 1)
    same = F.transform(every, lambda other: tile(
        F.col("size") * 2, F.least("shard", other), F.greatest(F.col("shard"), other),
        F.when(other == F.col("shard"), 2).when(other > F.col("shard"), 0).otherwise(1)))
    as_short = F.transform(every, lambda other: tile(F.col("size") * 2 + 1, F.col("shard"), other, F.lit(0)))
    as_long = F.transform(every, lambda other: tile(F.col("size") * 2 - 1, other, F.col("shard"), F.lit(1)))
    tiles = sharded.select(F.explode(F.concat(same, as_short, as_long)).alias("t"), "choice", "word", "n")
    tiles = tiles.select(F.col("t.tile").alias("key"), F.col("t.side").alias("side"), "choice", "word", "n")
    return tiles.groupBy("key").applyInArrow(_bucket_work(group, True), _near_schema())


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of links (word, form): forms followed to the last, twice as far with each round.

    A form is TIMES as frequent as its word at least, so no chain is longer
    than the digits of a count, and a few rounds end it.
    """
    reached = cut_lineage(links.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut_lineage(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if further.where("moved").isEmpty():
            return further.select("word", "root")
        reached = further.select("word", "root")


def variants(docs: DataFrame, rule=dropped, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    vocabulary = cut_lineage(word_counts(docs, rule=rule))
    best = near_words(vocabulary)
    is_form = F.col("best_n") >= times * F.col("n")
    judged = cut_lineage(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    known = roots(judged.where("form is not null"))
    return judged.join(known, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
