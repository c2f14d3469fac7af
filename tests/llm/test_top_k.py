"""Top-k inner products against all pairs."""

import math

import numpy as np
import pytest

from leavewatch.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def plain_top(rows, k=5, every=50):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in good:
        if q % every == 0:
            ranked = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(y) == len(x))[:k]
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(ranked, 1)}
    return out


def search(spark, rows, parts=3, **options):
    df = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], SCHEMA).repartition(parts)
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in cover_tree.top_k(df, cover_tree.stated_queries(df), **options).collect()}


def vectors(n, d=8, clusters=5, seed=0):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(clusters, d))
    return [(i, (centers[i % clusters] + 0.3 * r.normal(size=d)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("block", [4096, 3])
def test_against_all_pairs(spark, block):
    rows = vectors(700)
    assert search(spark, rows, query_block=block) == plain_top(rows)


def test_odd_vectors(spark):
    rows = vectors(60) + [(100, None), (150, []), (200, [1.0] * 8), (201, [1.0] * 8), (202, [1.0] * 8), (203, [None] + [1.0] * 7),
                          (250, [float("nan")] * 8), (251, [float("inf")] * 8), (300, [1.0, 2.0]), (301, [-3.0, 1.5]), (None, [1.0] * 8)]
    assert search(spark, rows) == plain_top(rows)


def test_copies_and_ties(spark):
    rows = [(i, [0.5, -0.25, 1.0]) for i in range(230)] + [(1000 + i, [0.0, 0.0, 0.0]) for i in range(60)]
    assert search(spark, rows) == plain_top(rows)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0]), (3, [2.0])]
    assert search(spark, rows) == {(0, 1, 3, 131072)}
    assert search(spark, []) == set()


def test_large_components_stay_exact():
    q, v = np.array([[3e9, 1.0]]), np.array([[2e9, 7.0], [2e9, 8.0]])
    assert cover_tree.products(q, v).tolist() == [[6 * 10**18 + 7, 6 * 10**18 + 8]]


@pytest.mark.parametrize("clusters", [0, 6])
def test_tree_covers_its_rows(clusters):
    r = np.random.default_rng(1)
    v = r.normal(size=(3000, 4)) * 0.05 ** r.integers(0, 2, size=(3000, 1))
    if clusters:
        v += 20 * r.normal(size=(clusters, 4))[r.integers(0, clusters, size=3000)]
    depth = []

    def walk(node, level):
        depth.append(level)
        assert np.sqrt(((v[node.rows] - node.center) ** 2).sum(axis=1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children]).tolist()) == sorted(node.rows.tolist())
            centers = np.stack([c.center for c in node.children])
            apart = np.sqrt(((centers[:, None] - centers) ** 2).sum(axis=2)) + np.eye(len(centers)) * 1e9
            assert apart.min() > node.radius / cover_tree.BASE
        for c in node.children:
            assert c.radius <= node.radius / cover_tree.BASE
            walk(c, level + 1)

    walk(cover_tree.cover_tree(v), 0)
    assert max(depth) >= 3


def walked(v, queries, k=5):
    s = cover_tree.Search(v[queries], queries, v, np.arange(len(v)), k)
    s.walk(cover_tree.cover_tree(v[queries], cover_tree.QUERY_LEAF, cover_tree.QUERY_LEAST_EACH), cover_tree.cover_tree(v))
    for i, q in enumerate(queries.tolist()):
        scores = (v @ v[q]).astype(int)
        expected = sorted((-x, j) for j, x in enumerate(scores.tolist()) if j != q)[:k]
        assert s.best[i] == expected
    return s.scored / (len(v) * len(queries))


def test_clusters_leave_most_pairs_unscored():
    r = np.random.default_rng(2)
    centers = r.normal(size=(40, 16))
    v = np.floor(256 * (centers[r.integers(0, 40, size=4000)] + 0.05 * r.normal(size=(4000, 16))))
    assert walked(v, np.arange(0, 4000, 50)) < 0.5


def test_an_even_sphere_is_scored_whole():
    """Nothing can be pruned there, and nothing is lost."""
    v = np.random.default_rng(3).normal(size=(1500, 48))
    v = np.floor(256 * v / np.sqrt((v ** 2).sum(axis=1, keepdims=True)))
    assert 0.5 < walked(v, np.arange(0, 1500, 50)) <= 1
