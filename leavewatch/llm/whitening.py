"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

Entries become integers x = floor(256 c). The fit list holds each distinct x
vector once and is stored. With X its rows less their mean, each step takes two
passes over it: one for Xv, one for the product of X transposed with the new
left vector. Left vectors are as long as the list; every one is X y for a short
vector y, so tasks make the rows of all of them anew from the y's, and only
sums go between executors and driver: no vector as long as the table is stored.
Both sides are reorthogonalised against all vectors before, in every step. The
SVD of the small bidiagonal matrix gives components and deviations.

The steps end when the wanted components stand still and what is left of the
trace cannot hide a larger eigenvalue, or when the space is exhausted. Where a
step breaks down, because the space found so far maps into itself, the next
right vector is a new one orthogonal to all before: equal eigenvalues each get
their component.

Nulls: rows whose vector is null, empty, or holds null or non-finite entries
are dropped, and so are entries beyond 2**44 after scaling, which are no exact
sums, and vectors of another length than the most frequent (ties: the
shortest). Rows with a null vec_id, and rows that repeat, each give their
result. Fewer than k components come back where the list has a lower rank: none
for an empty table or a single vector. Ties of eigenvalues leave the choice of
components open, as the definition does. A deviation beyond 64 bits is null.
Vectors that hold a third of all rows are one row per task before the shuffle.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leavewatch.sources.shared_storage import cut_lineage

COMPONENTS = 4
SCALE = 256
LARGEST = 1 << 44   # of an entry after scaling
_SPLIT = 22         # sums are kept in two halves of this many bits
BATCH_ENTRIES = 1 << 20
_EPS = np.finfo(np.float64).eps
_LONG = (1 << 63) - 1


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part, x as array<long>."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda c: F.floor(SCALE * c))
    whole = F.forall(F.col("embedding").cast("array<double>"),
                     lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST // SCALE))
    good = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(F.coalesce(whole, F.lit(False)))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.cast("array<long>").alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(-1, d)


def _blocks(batches: Iterator[pa.RecordBatch], d: int, column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The batches in pieces of bounded size, with their vectors as a matrix."""
    rows = max(1, BATCH_ENTRIES // d)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            yield piece, _matrix(piece.column(piece.schema.get_field_index(column)), d)


def _summed(rows: DataFrame, partial: Callable[[np.ndarray], np.ndarray], d: int, size: int, kind: str) -> list:
    """Sum over all rows of partial(block), a flat array of `size` numbers; one row of sums per task goes out."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64 if kind == "long" else np.float64)
        for _, block in _blocks(batches, d):
            total += partial(block)
        places = pa.array(np.arange(size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total)], ["place", "value"])

    sums = (rows.select("x").mapInArrow(work, f"place int, value {kind}")
            .groupBy("place").agg(F.sum("value").alias("value")).collect())  # `size` rows
    out = [0] * size
    for row in sums:
        out[row["place"]] = row["value"]
    return out


class FitList:
    """The distinct vectors, their number and sums, and sums of products with their centred rows."""

    def __init__(self, x: DataFrame, d: int):
        self.rows, self.d = cut_lineage(x.select("x").distinct()), d
        mask = (1 << _SPLIT) - 1

        def partial(block: np.ndarray) -> np.ndarray:
            return np.concatenate([(block >> _SPLIT).sum(axis=0), (block & mask).sum(axis=0), [len(block)]])

        sums = _summed(self.rows, partial, d, 2 * d + 1, "long")
        self.n = int(sums[-1])
        self.sums = [(int(h) << _SPLIT) + int(low) for h, low in zip(sums[:d], sums[d:2 * d])]
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(d)

    def products(self, partial: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """Sum of partial(centred block) over the list."""
        mean = self.mean
        return np.array(_summed(self.rows, lambda block: partial(block - mean), self.d, size, "double"))


def _fresh(rng: np.random.Generator, known: np.ndarray, d: int) -> np.ndarray:
    """A unit vector orthogonal to the known ones."""
    v = rng.standard_normal(d)
    for _ in range(3):
        v -= known.T @ (known @ v)
        v /= np.sqrt(v @ v)
    return v


class Bidiagonal:
    """X V = U B with orthonormal V (rows of `right`) and U = X Y (rows of `left` are the y's)."""

    def __init__(self, fit: FitList, seed: int = 12):
        self.fit, self.rng, d = fit, np.random.default_rng(seed), fit.d
        self.trace = float(fit.products(lambda a: np.array([(a * a).sum()]), 1)[0])
        self.right, self.left = np.empty((0, d)), np.empty((0, d))
        self.transposed = np.empty((0, d))       # rows: the product of X transposed with each left vector
        self.diagonal, self.above = [], []       # above[i] couples step i with step i + 1
        self.next, self.tiny = _fresh(self.rng, self.right, d), 64 * _EPS * np.sqrt(self.trace)

    def step(self) -> None:
        v, left = self.next, self.left
        self.right = np.vstack([self.right, v])
        # Xv, and its products with all left vectors so far.
        y = v.copy()
        basis = np.vstack([left, v]).T
        got = self.fit.products(lambda a: (p := a @ basis).T @ p[:, -1], len(left) + 1)
        if len(left):
            y -= left.T @ got[:-1]
        # The product of X transposed with what is left of it, and the second round against the left vectors.
        basis = np.vstack([left, y]).T

        def back(a: np.ndarray) -> np.ndarray:
            p = a @ basis
            return np.concatenate([p.T @ p[:, -1], a.T @ p[:, -1]])

        got = self.fit.products(back, len(left) + 1 + self.fit.d)
        again, square, product = got[:len(left)], got[len(left)], got[len(left) + 1:]
        alpha = float(np.sqrt(max(square - again @ again, 0.0)))
        self.diagonal.append(alpha if alpha > self.tiny else 0.0)
        if alpha > self.tiny:
            if len(left):
                y -= left.T @ again
                product = product - self.transposed.T @ again
            self.left = np.vstack([left, y / alpha])
            product = product / alpha
        else:  # no new left vector: a row of zeros keeps the places
            self.left, product = np.vstack([left, np.zeros(self.fit.d)]), np.zeros(self.fit.d)
        self.transposed = np.vstack([self.transposed, product])
        rest = product - alpha * v if alpha > self.tiny else product
        for _ in range(2):
            rest = rest - self.right.T @ (self.right @ rest)
        beta = float(np.sqrt(rest @ rest))
        if len(self.right) < self.fit.d:
            if beta > self.tiny:
                self.above.append(beta)
                self.next = rest / beta
            else:
                self.above.append(0.0)
                self.next = _fresh(self.rng, self.right, self.fit.d)

    def solved(self, k: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """The k largest singular values, their right vectors, and whether these are final."""
        m = len(self.diagonal)
        small = np.diag(self.diagonal) + np.diag(self.above[:m - 1], 1)
        ends, values, coefficients = np.linalg.svd(small)
        vectors = coefficients[:k] @ self.right
        if m == self.fit.d:
            return values[:k], vectors, True
        coupled = self.above[m - 1]
        still = m > k and bool((coupled * np.abs(ends[-1, :k]) <= 4 * _EPS * values[0]).all())
        rest = self.trace - float((values ** 2).sum())
        return values[:k], vectors, still and coupled > 0 and rest < values[k - 1] ** 2 / 2


def components(fit: FitList, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues of the covariance, largest first, unit eigenvectors as rows, and the trace."""
    if fit.n < 2:
        return np.empty(0), np.empty((0, fit.d)), 0.0
    space = Bidiagonal(fit)
    if space.trace == 0:
        return np.empty(0), np.empty((0, fit.d)), 0.0
    done = False
    while not done:
        space.step()
        values, vectors, done = space.solved(k)
    real = values > space.tiny * np.sqrt(fit.d)
    values, vectors = values[real], vectors[real]
    vectors = vectors / np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    return values ** 2 / fit.n, vectors, space.trace / fit.n


def identity_error(fit: FitList, scale: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened fit list less the identity."""
    k = scale.shape[1]
    mean = fit.products(lambda a: (a @ scale).sum(axis=0), k) / fit.n

    def partial(a: np.ndarray) -> np.ndarray:
        w = a @ scale - mean
        return (w.T @ w).ravel()

    return float(np.abs(fit.products(partial, k * k).reshape(k, k) / fit.n - np.eye(k)).max())


def deviations(block: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)**2 of each row, exact; None beyond 64 bits."""
    largest = n * int(np.abs(block).max(initial=0)) + max(map(abs, sums))
    if len(sums) * largest ** 2 <= _LONG:
        away = n * block - np.array(sums, dtype=np.int64)
        return (away * away).sum(axis=1).tolist()
    whole = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in block.tolist()]
    return [v if v <= _LONG else None for v in whole]


RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whitened(vectors: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """One row per remaining row and component: see RESULT; fitted on the distinct vectors of the table itself."""
    spark = vectors.sparkSession
    rows = integer_vectors(vectors)
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").head()
    if common is None:
        return spark.createDataFrame([], RESULT)
    d = common["d"]
    rows = rows.where(F.size("x") == d)
    fit = FitList(rows, d)
    values, found, trace = components(fit, k)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    scale = (found / np.sqrt(values)[:, None]).T
    error, explained = identity_error(fit, scale), values / trace
    n, sums, mean = fit.n, fit.sums, fit.mean

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, block in _blocks(batches, d):
            m, wide = len(block), len(explained)
            ids = piece.column(0)
            yield pa.RecordBatch.from_arrays([
                pc.take(ids, pa.array(np.repeat(np.arange(m), wide))),
                pa.array(np.tile(np.arange(1, wide + 1, dtype=np.int32), m)), pa.array(np.full(m * wide, n)),
                pc.take(pa.array(deviations(block, n, sums), pa.int64()), pa.array(np.repeat(np.arange(m), wide))),
                pa.array(((block - mean) @ scale).ravel()), pa.array(np.tile(explained, m)),
                pa.array(np.full(m * wide, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(project, RESULT)
