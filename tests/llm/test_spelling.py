"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from conftest import MEDIUM

from leavewatch.llm import queries, spelling


def plain_counts(docs):
    out = Counter()
    for doc_id, text in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", text):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def plain_variants(counts):
    """word -> (form, root, n, near words, n of the form), by words with one letter taken out."""
    less = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            less[i, w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for (i, rest), own in less.items():
        for a in own:
            near[a] |= own - {a}
            if rest in counts:
                near[a].add(rest)
                near[rest].add(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None)
    return out


def found(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def vocabulary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


def dense(seed, n, letters="abé", length=(7, 9)):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(*length))): r.choice([2, 3, 25, 300, 4000]) for _ in range(n)}


def near(df):
    return {r.word: (r.n_near, r.best_n, r.best) for r in df.collect()}


def plain_near(counts):
    out = {}
    for w, (*_, n_near, _) in plain_variants(counts).items():
        if n_near:
            others = [x for x in counts if abs(len(x) - len(w)) <= 1 and x != w and one_edit(w, x)]
            best = min(others, key=lambda x: (-counts[x], x))
            out[w] = (len(others), counts[best], best)
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


@pytest.mark.parametrize("make", [odd.documents, odd.repeated, odd.empty])
def test_odd_documents(spark, make):
    docs = make(spark)
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(spelling.variants(docs)) == plain_variants(plain_counts(pairs))


@pytest.mark.parametrize("seed", range(3))
def test_dense_vocabulary(spark, seed):
    """Few letters, so that most words have near words, anagrams and equal counts."""
    counts = dense(seed, 700)
    assert near(spelling.near_words(vocabulary(spark, counts))) == plain_near(counts)


def test_large_blocks_go_in_tiles(spark):
    counts = dense(7, 900, "abcà")
    assert near(spelling.near_words(vocabulary(spark, counts), tile=8)) == plain_near(counts)


def test_every_edit_is_found(spark):
    """A word with all its single edits, at every place, with letters of every group."""
    word, letters = "maßtérial", "abcdefghijklmnopqrstuvwxyzàßéÿ÷À"
    edits = {word}
    for i in range(len(word) + 1):
        edits |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            edits |= {word[:i] + c + word[i + 1:] for c in letters} | {word[:i] + word[i + 1:]}
    counts = {w: 3 for w in edits} | {word: 100}
    got = near(spelling.near_words(vocabulary(spark, counts)))
    assert got[word][0] == len(edits) - 1
    assert all(got[w][1:] == (100, word) for w in edits if w != word)


def test_roots_follow_chains(spark):
    chain = ["aaaaaaaz", "aaaaaazz", "aaaaazzz", "aaaazzzz", "aaazzzzz", "aazzzzzz"]
    links = spark.createDataFrame(list(zip(chain, chain[1:])) + [("bbbbbbbb", "bbbbbbbc")], "word string, form string")
    assert {r.word: r.root for r in spelling.roots(links).collect()} == {w: chain[-1] for w in chain[:-1]} | {"bbbbbbbb": "bbbbbbbc"}
    assert spelling.roots(links.limit(0)).count() == 0


def test_pieces_of_a_long_text_keep_runs_whole(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 10)
    r = random.Random(4)
    for _ in range(50):
        text = "".join(r.choice("abcÀé ,7ZĀ") for _ in range(300)) + "x" * r.randint(0, 40)
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        assert [w for piece in spelling.runs(text, 3) for w in piece] == re.findall("[a-zÀ-ÿ]{3,}", low)


def test_words_beyond_what_a_task_holds(spark, monkeypatch):
    docs = [(i, " ".join(odd.prose(i * 7 + k, 1) + "xyzabcd" for k in range(40))) for i in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(spelling, "_HELD", 50)
    assert {r.word: r.n for r in spelling.word_counts(frame).collect()} == plain_counts(docs)


def test_letter_hashes_of_near_words_differ():
    assert len(set(spelling._WEIGHTS.tolist())) == 90 and np.all(spelling._WEIGHTS > 0)


def test_registered_query_on_the_whole_table(spark):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op13_spelling_variants"](spark, MEDIUM)) == plain_variants(plain_counts(pairs))
