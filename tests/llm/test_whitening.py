"""Whitened vectors against NumPy's eigenvectors and Python's integers."""

import math
from collections import defaultdict

import numpy as np
import pytest
from conftest import MEDIUM

from leavewatch.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, x string, value string, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", "c", "c") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, k=4):
    """(fit list, S, eigenvalues, unit eigenvectors as columns) of rows that take part."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in good}), dtype=np.int64)
    centred = fit - fit.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    order = np.argsort(-values)[:k]
    return good, fit, values.sum(), values[order], vectors[:, order]


def check(result, rows, k=4, rank=None):
    good, fit, trace, values, vectors = plain(rows, k)
    n, sums = len(fit), fit.sum(axis=0).tolist()
    got = defaultdict(list)
    for r in result.collect():
        got[r.component].append(r)
    assert sorted(got) == list(range(1, (rank or k) + 1))
    for c, own in got.items():
        expected = defaultdict(list)
        for i, v in good:
            deviation = sum((n * x - s) ** 2 for x, s in zip(v, sums))
            projected = (np.array(v) - fit.mean(axis=0)) @ vectors[:, c - 1] / math.sqrt(values[c - 1])
            expected[i].append((deviation, projected))
        seen = defaultdict(list)
        for r in own:
            assert r.n == n and r.explained == pytest.approx(values[c - 1] / trace, rel=1e-10) and r.identity_error < 1e-9
            seen[r.vec_id].append((r.deviation, r.whitened))
        assert seen.keys() == expected.keys()
        a = np.array([w for i in expected for _, w in sorted(expected[i])])
        b = np.array([w for i in expected for _, w in sorted(seen[i])])
        assert np.abs(a - b * np.sign(a @ b)).max() < 1e-8
        assert all(sorted(d for d, _ in expected[i]) == sorted(d for d, _ in seen[i]) for i in expected)


def vectors(n, d, seed=0):
    r = np.random.default_rng(seed)
    return [(i, v) for i, v in enumerate((r.standard_normal((n, d)) * np.arange(1, d + 1) ** 0.5).tolist())]


def test_odd_vectors(spark):
    rows = vectors(60, 6) + [(None, [1.0] * 6), (3, [0.5] * 6), (100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
                             (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5), (105, [-0.0] * 6), (106, [0.0] * 6)]
    rows += [(200 + i, [2.0, 1.0, 0.0, -1.0, 5.0, 3.0]) for i in range(60)]  # one vector in half of the rows
    check(whitening.whitened(frame(spark, rows)), rows)
    # Vectors of another length take no part.
    found = whitening.whitened(frame(spark, rows + [(900, [1.0, 2.0])]))
    check(found, rows)


def test_equal_eigenvalues_each_get_a_component(spark):
    rows = [(2 * i + (s > 0), [s * 3.0 if j == i else 0.0 for j in range(5)]) for i in range(5) for s in (-1, 1)]
    found = whitening.whitened(frame(spark, rows)).collect()
    assert len(found) == 10 * 4
    assert all(r.explained == pytest.approx(0.2) and r.identity_error < 1e-9 for r in found)


def test_few_dimensions_and_low_rank(spark):
    check(whitening.whitened(frame(spark, vectors(20, 2))), vectors(20, 2), k=2)
    line = [(i, [float(i), 2.0 * i, -float(i), 1.0, 0.0]) for i in range(15)]
    check(whitening.whitened(frame(spark, line)), line, k=1, rank=1)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_fit(spark, rows):
    assert whitening.whitened(frame(spark, rows)).collect() == []


def test_deviation_is_exact_beyond_doubles():
    block = np.array([[2 ** 30, -5], [1, 2 ** 33]], dtype=np.int64)
    sums = [2 ** 30 + 1, 2 ** 33 - 5]
    expected = [sum((2 * x - s) ** 2 for x, s in zip(row, sums)) for row in block.tolist()]
    assert whitening.deviations(block, 2, sums) == [v if v < 2 ** 63 else None for v in expected]
    small = np.array([[3, 4]], dtype=np.int64)
    assert whitening.deviations(small, 2, [1, 1]) == [25 + 49]


def test_components_stop_early_only_with_a_certificate(spark):
    """Two large directions of forty: the steps end long before the fortieth."""
    r = np.random.default_rng(5)
    scale = np.array([400, 300, 200, 100] + [0.05] * 36)
    rows = [(i, v) for i, v in enumerate((r.standard_normal((300, 40)) * scale).tolist())]
    fit = whitening.FitList(whitening.integer_vectors(frame(spark, rows)), 40)
    space = whitening.Bidiagonal(fit)
    done, steps = False, 0
    while not done:
        space.step()
        steps += 1
        _, _, done = space.solved(4)
    assert steps < 30
    assert np.abs(space.right @ space.right.T - np.eye(steps)).max() < 1e-12
    check(whitening.whitened(frame(spark, rows)), rows)


def test_registered_query_on_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{MEDIUM}/embeddings.parquet").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, MEDIUM), rows)
