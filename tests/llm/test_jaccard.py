"""Near duplicates against all pairs."""

import random

import numpy as np
import odd
import plain
import pytest

from leavewatch.llm import jaccard_join
from leavewatch.llm.components import components

NO_ID = -(1 << 63)


def rows(df):
    return {r.doc_id: (r.class_id, r.class_size, r.n_links, r.group_id) for r in df.collect()}


def mutated(text, seed, share):
    r = random.Random(seed)
    return " ".join(odd.prose(r.randrange(10**6), 1) if r.random() < share else w for w in text.split(" "))


@pytest.mark.parametrize("make", [odd.documents, odd.repeated, odd.empty])
def test_odd_documents(spark, make):
    docs = make(spark)
    texts = odd.by_id([(NO_ID if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()])
    none = lambda x: None if x == NO_ID else x
    expected = {none(i): (none(c), n, links, none(g)) for i, (c, n, links, g) in plain.near_duplicates(texts).items()}
    assert rows(jaccard_join.similar(docs)) == expected
    left = jaccard_join.one_of_each_group(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {g for _, _, _, g in expected.values()}
    assert left.count() == len({g for _, _, _, g in expected.values()})


@pytest.mark.parametrize("shard, items", [(1024, 1 << 21), (16, 1 << 21), (1024, 500)])
def test_groups_of_near_copies(spark, shard, items):
    docs = []
    for base in range(3):
        text = odd.prose(500 + base, 120)
        docs += [mutated(text, 1000 * base + k, 0.004 * (k % 12)) for k in range(60)]
    docs += [odd.prose(700 + k, 80) for k in range(40)]
    docs = list(enumerate(docs))
    random.Random(3).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert rows(jaccard_join.similar(df, shard=shard, shard_items=items)) == plain.near_duplicates(dict(docs))


def test_prefix_is_shortened_until_the_target():
    assert jaccard_join.prefix_length(0.8, 0.9995) == 8
    assert jaccard_join.prefix_length(0.8, 0.5) > 8 > jaccard_join.prefix_length(0.5, 0.9995)


def test_least_similarities_are_those_of_small_sets():
    for threshold in (0.5, 0.8, 0.9):
        for n in range(1, 30):
            near = [i / (n + m - i) for m in range(1, 80) for i in range(1, min(n, m) + 1)
                    if i >= threshold * (n + m - i) - 1e-9 and not i == n == m]
            assert jaccard_join.least_similarity(n, threshold) == min(near, default=None)
    limits = jaccard_join.prefix_limits()
    assert limits[3] == jaccard_join.LONGEST + 1 and limits[4] == limits[8] == limits[-1] == 8
    assert limits[-1] < limits[6] <= limits[7] <= jaccard_join.LONGEST


@pytest.mark.parametrize("crowd", [16, 1])
def test_prefixes_under_a_key_are_as_long_as_its_members_allow(monkeypatch, crowd):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    r = np.random.default_rng(4)
    key = r.integers(0, 40, size=400).astype(np.uint64)
    path = r.integers(0, 2, size=(400, 8)).astype(np.uint8)
    levels = np.where(key % 3 == 0, r.integers(2, 5, size=400), np.where(key % 3 == 1, 8, r.integers(0, 9, size=400))).astype(np.uint8)
    node = r.permutation(400)
    as_number = np.ascontiguousarray(path).view(">u8").ravel().astype(np.uint64)
    expected = {}
    for k in np.unique(key):
        own = np.flatnonzero(key == k)
        low = int(levels[own].min())
        parts = {}
        for i in own:
            parts.setdefault(path[i, :low].tobytes(), []).append(int(node[i]))
        if len(parts) > crowd:
            parts = {b"": sorted(int(node[i]) for i in own)}
        for members in parts.values():
            expected[min(members)] = sorted(members)
    _, _, _, head, a, b = jaccard_join.joined_prefixes(key, as_number, levels, node)
    found = {int(h): [int(h)] for h in head}
    for x, y in zip(a.tolist(), b.tolist()):
        found[x].append(y)
    assert {h: sorted(m) for h, m in found.items()} == expected


@pytest.mark.parametrize("parts", [1, 6])
def test_short_texts_lose_no_link(spark, parts):
    """Sets of 1 to 12 shingles, whose prefixes are longer than those of others, beside variants with a word more or less."""
    docs = []
    for base in range(150):
        words = odd.prose(3000 + base, 5 + base % 12).split(" ")
        docs += [" ".join(words), " ".join([*words, "more"]), " ".join(words[1:]), " ".join(["and", *words, "less"]), " ".join([*words[:-1], "other"])]
    docs = list(enumerate(docs))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    assert rows(jaccard_join.similar(df)) == plain.near_duplicates(dict(docs))


def test_common_counts():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 400, size=int(r.integers(1, 200)))).astype(np.uint64) for _ in range(50)]
    found = jaccard_join.common(sets[:20], sets[20:])
    assert found.tolist() == [[len(np.intersect1d(a, b)) for b in sets[20:]] for a in sets[:20]]


def test_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    expected = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
