"""Elastic-net logistic regression over a whole grid and all folds at once.

Every (point, fold) is a model. Each pass over the stored user table gives all
models that are not done their loss, gradient and curvature, summed in the
tasks and then by model; what reaches the driver is models x features squared
numbers, whatever the number of users. There each model takes a proximal Newton
step: the minimum of its quadratic model with the penalty, found exactly. A
step that does not lower the objective is halved. A model is done when no
subgradient is further from 0 than ``TOLERANCE``, so its optimality is proven
by the returned numbers. A dozen passes serve a grid that
takes hundreds of separate fits of many passes each.

The whole training part is one more fold, with nobody held out, so the best
point needs no refit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.numeric import sign_colour
from leavewatch.plans import modelling
from leavewatch.plans.score_table import ScoreTable, ranked
from leavewatch.sources.shared_storage import cut_lineage

TOLERANCE = 1e-13       # of a subgradient, against 1 and the penalty
ACCEPTED = 1e-9         # the same, where rounding allows no better; beyond is an error
WHOLE = -1              # the fold with nobody held out
MAX_FEATURES = 400      # beyond, curvatures are too large for the driver; fit_churn_model takes any number
MAX_PASSES = 200
_CHUNK = 4096


@dataclass(frozen=True)
class Point:
    """A penalty: its weight against the mean loss, or the inverse of that against the summed loss."""

    params: str
    l1_ratio: float
    strength: float | None = None
    inverse: float | None = None

    def weight(self, n_rows: float) -> float:
        return self.strength if self.inverse is None else 1.0 / (self.inverse * n_rows)


def penalty_points(values: dict[str, Sequence[float]] | None = None) -> list[Point]:
    """The grid of :func:`modelling.logistic_search`, in its order."""
    values = values or fixed.LARGE_LOGISTIC_GRID
    return [Point(f"elasticNetParam={ratio:g}, regParam={strength:g}", ratio, strength=strength)
            for ratio in values["elasticNetParam"] for strength in values["regParam"]]


def inverse_strength_points(strengths: Sequence[float] | None = None,
                            l1_ratios: Sequence[float] | None = None) -> list[Point]:
    """Penalties given as inverse strength C of the summed loss, so that each fit counts its own rows."""
    return [Point(f"C={c:g}, l1_ratio={ratio:g}", ratio, inverse=c)
            for c in strengths or fixed.INVERSE_STRENGTHS for ratio in l1_ratios or fixed.L1_RATIOS]


def prepared(table: DataFrame, folds: int, test_percent: int = 25, fit_scope: str = "train",
             key: str = modelling.KEY, label: str = modelling.LABEL) -> tuple[DataFrame, list[str]]:
    """(key, label, split, fold, x) with features scaled to [0, 1], stored; and the names of the features.

    A feature that is constant where the scaler looks is 0.5. Features may not
    be null.
    """
    names = modelling.feature_columns(table, key, label)
    if len(names) > MAX_FEATURES:
        raise ValueError(f"more than {MAX_FEATURES} features")
    stored = cut_lineage(modelling.with_fold(modelling.with_split(table, test_percent, key), folds, key))
    seen = stored if fit_scope == "all" else stored.where(F.col("split") == "train")
    bounds = seen.agg(*[F.struct(F.min(F.col(f"`{c}`").cast("double")), F.max(F.col(f"`{c}`").cast("double")))
                        for c in names]).head()
    scaled = [F.lit(0.5) if low == high else (F.col(f"`{c}`") - low) / (high - low)
              for c, (low, high) in zip(names, bounds)]
    return cut_lineage(stored.select(
        F.col(key), F.col(label).cast("double").alias("label"), "split", "fold", F.array(*scaled).alias("x"))), names


Partial = Callable[[int, np.ndarray, np.ndarray], dict[int, np.ndarray]]


def _summed(rows: DataFrame, partial: Partial) -> dict[int, np.ndarray]:
    """model -> sum over all rows of what ``partial(fold, x with a leading 1, label)`` gives for a block of one fold."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                piece = batch.slice(at, _CHUNK)
                fold, label = np.asarray(piece.column(0)), np.asarray(piece.column(1))
                x = np.asarray(piece.column(2).flatten()).reshape(len(fold), -1)
                x = np.column_stack([np.ones(len(fold)), x])
                for f in np.unique(fold).tolist():
                    for model, value in partial(f, x[fold == f], label[fold == f]).items():
                        total[model] = total[model] + value if model in total else value
        if total:
            values = pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), values], ["model", "sums"])

    def add(parts: pa.Table) -> pa.Table:
        n = parts.num_rows
        sums = np.asarray(parts.column("sums").combine_chunks().flatten()).reshape(n, -1).sum(axis=0)
        return pa.table({"model": parts.column("model").slice(0, 1), "sums": pa.array([sums.tolist()], pa.list_(pa.float64()))})

    kind = "model int, sums array<double>"
    parts = rows.select("fold", "label", "x").mapInArrow(work, kind).groupBy("model").applyInArrow(add, kind)
    return {r["model"]: np.array(r["sums"]) for r in parts.collect()}


def _triangle(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d)


def _measured(weights: np.ndarray, folds: np.ndarray, models: np.ndarray) -> Partial:
    """Loss, gradient and curvature of models with the given weights, rows outside their held-out fold."""
    def partial(fold: int, x: np.ndarray, y: np.ndarray) -> dict[int, np.ndarray]:
        own = np.flatnonzero(folds != fold)
        margin = x @ weights[own].T
        chance = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
        loss = (np.logaddexp(0, margin) - y[:, None] * margin).sum(axis=0)
        gradient = (chance - y[:, None]).T @ x
        i, j = _triangle(x.shape[1])
        curvature = (chance * (1 - chance)).T @ (x[:, i] * x[:, j])
        out = np.column_stack([loss, gradient, curvature])
        return {int(models[m]): out[k] for k, m in enumerate(own.tolist())}

    return partial


class Models:
    """All models of a search and where each stands. Arrays run over the models; column 0 is the intercept."""

    def __init__(self, rows: DataFrame, points: Sequence[Point], folds: int, standardised: bool):
        self.rows, self.points = rows.where(F.col("split") == "train"), list(points)
        sums = _summed(self.rows, lambda fold, x, y: {fold: np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [y.sum()]])})
        d = (len(next(iter(sums.values()))) - 1) // 2
        for fold in range(folds):
            n, hits = sums.get(fold, np.zeros(2 * d + 1))[[0, -1]]
            if not 0 < hits < n:
                raise ValueError(f"not every one of the {folds} folds holds both classes")
        self.n_train = int(sum(s[0] for s in sums.values()))
        self.point = np.repeat(np.arange(len(points)), folds + 1)
        self.fold = np.tile(np.append(np.arange(folds), WHOLE), len(points))
        size = len(self.point)
        self.n, lasso, ridge, self.fixed = np.empty(size), np.zeros((size, d)), np.zeros((size, d)), np.zeros((size, d), bool)
        for m, (p, held) in enumerate(zip(self.point.tolist(), self.fold.tolist())):
            own = sum(s for f, s in sums.items() if f != held)
            n, mean, square = own[0], own[:d] / own[0], own[d:2 * d] / own[0]
            spread = np.sqrt(np.maximum(square - mean ** 2, 0) * n / (n - 1))
            flat = spread <= 1e-9 * np.sqrt(square)
            weight = points[p].weight(n)
            scale = np.where(flat, 0, spread) if standardised else np.ones(d)
            lasso[m], ridge[m] = weight * points[p].l1_ratio * scale, weight * (1 - points[p].l1_ratio) * scale ** 2
            self.fixed[m] = flat & standardised
            self.n[m] = n
        lasso[:, 0] = ridge[:, 0] = 0
        self.fixed[:, 0] = False
        self.lasso, self.ridge = lasso, ridge
        self.scale = 1 + (lasso + ridge).max(axis=1)  # violations are rounded at this scale
        self.weights = np.zeros((size, d))
        self.violation = np.full(size, np.inf)
        self.passes = 0

    def _measure(self, candidate: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Objective, gradient of its smooth part and curvature of that, per active model."""
        d = candidate.shape[1]
        sums = _summed(self.rows, _measured(candidate[active], self.fold[active], active))
        self.passes += 1
        got = np.stack([sums[int(m)] for m in active]) / self.n[active][:, None]
        w, ridge = candidate[active], self.ridge[active]
        value = got[:, 0] + (ridge * w * w).sum(axis=1) / 2 + (self.lasso[active] * np.abs(w)).sum(axis=1)
        i, j = _triangle(d)
        curvature = np.empty((len(active), d, d))
        curvature[:, i, j] = curvature[:, j, i] = got[:, 1 + d:]
        curvature[:, np.arange(d), np.arange(d)] += ridge
        return value, got[:, 1:1 + d] + ridge * w, curvature

    def solve(self) -> None:
        """Advance all models until each is done."""
        size, d = self.weights.shape
        value, step = np.full(size, np.inf), np.ones(size)
        gradient, curvature, target = np.empty((size, d)), np.empty((size, d, d)), np.zeros((size, d))
        active, idle = np.arange(size), np.zeros(size, dtype=int)
        while len(active) and self.passes < MAX_PASSES:
            candidate = self.weights + step[:, None] * (target - self.weights)
            found, slope, bend = self._measure(candidate, active)
            before = self.violation[active].copy()
            # What rounding hides is no reason to reject a step.
            better = found <= value[active] + 1e-14 * np.abs(found)
            took = active[better]
            self.weights[took], value[took], step[took] = candidate[took], found[better], 1.0
            gradient[took], curvature[took] = slope[better], bend[better]
            self.violation[took] = distance_to_optimum(self.weights[took], gradient[took], self.lasso[took], self.fixed[took])
            step[active[~better]] /= 2
            # Where rounding ends the descent the last passes gain nothing.
            idle[active] = np.where(self.violation[active] < before / 2, 0, idle[active] + 1)
            at_rest = (idle >= 3) & (self.violation <= ACCEPTED * self.scale)
            active = active[(self.violation[active] > TOLERANCE * self.scale[active]) & ~at_rest[active] & (step[active] > 1e-12)]
            fresh = np.intersect1d(active, took)
            target[fresh] = newton_targets(self.weights[fresh], gradient[fresh], curvature[fresh], self.lasso[fresh], self.fixed[fresh])
        if len(left := np.flatnonzero(self.violation > ACCEPTED * self.scale)):
            raise ArithmeticError(f"{len(left)} models are not optimal after {self.passes} passes")

    def model(self, point: int, fold: int = WHOLE) -> int:
        return int(np.flatnonzero((self.point == point) & (self.fold == fold))[0])

    def held_out_cells(self) -> np.ndarray:
        """Per model: rows by (label, prediction) of its held-out fold, as (00, 01, 10, 11)."""
        weights, folds = self.weights, self.fold

        def partial(fold: int, x: np.ndarray, y: np.ndarray) -> dict[int, np.ndarray]:
            own = np.flatnonzero(folds == fold)
            said, hit = x @ weights[own].T > 0, y > 0.5
            cells = np.column_stack([(said[hit == a] == b).sum(axis=0) for a in (False, True) for b in (False, True)])
            return {int(m): cells[k].astype(float) for k, m in enumerate(own.tolist())}

        sums = _summed(self.rows, partial)
        return np.stack([sums.get(m, np.zeros(4)) for m in range(len(folds))])


def distance_to_optimum(weights: np.ndarray, gradient: np.ndarray, lasso: np.ndarray, fixed_at_0: np.ndarray) -> np.ndarray:
    """Largest distance of 0 from the subgradients of a model's objective."""
    away = np.where(weights != 0, np.abs(gradient + lasso * np.sign(weights)), np.maximum(np.abs(gradient) - lasso, 0))
    return np.where(fixed_at_0, 0, away).max(axis=1)


def newton_targets(weights: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, lasso: np.ndarray,
                   fixed_at_0: np.ndarray) -> np.ndarray:
    """Minima of the quadratic models plus the absolute penalties, one per row."""
    return np.array([quadratic_minimum(h, h @ w - g, l, w, ~f) for w, g, h, l, f in
                     zip(weights, gradient, curvature, lasso, fixed_at_0)]).reshape(weights.shape)


def quadratic_minimum(curvature: np.ndarray, linear: np.ndarray, lasso: np.ndarray, start: np.ndarray,
                      free: np.ndarray) -> np.ndarray:
    """Minimum of x'Hx/2 - linear'x + sum(lasso |x|), by the set of coefficients that are not 0.

    With the signs known the minimum is a linear solve. A step that would turn
    a sign ends where that coefficient is 0, and drops it; where all signs
    hold, the zero whose subgradient is furthest off joins. Each step lowers
    the value, so no set comes twice.
    """
    x = np.where(free, start, 0.0)
    sign = np.where(lasso > 0, np.sign(x), 0.0)
    active = ((x != 0) | (lasso == 0)) & free
    slack = 1e-13 * (1 + np.abs(linear).max() + lasso.max())
    for _ in range(20 * len(x)):
        own = np.flatnonzero(active)
        block, right = curvature[np.ix_(own, own)], linear[own] - lasso[own] * sign[own]
        try:
            aim = np.linalg.solve(block, right)
        except np.linalg.LinAlgError:
            aim = np.linalg.lstsq(block, right, rcond=None)[0]
        turned = aim * sign[own] < 0
        if turned.any():
            move = aim - x[own]
            share = np.where(turned, np.divide(x[own], x[own] - aim, out=np.zeros(len(own)), where=turned), np.inf)
            first = int(np.argmin(share))
            x[own] += share[first] * move
            x[own[first]], sign[own[first]], active[own[first]] = 0.0, 0.0, False
            continue
        x[own] = aim
        slope = curvature @ x - linear
        beyond = np.where(~active & free, np.abs(slope) - lasso, -np.inf)
        worst = int(np.argmax(beyond))
        if beyond[worst] <= slack:
            break
        active[worst], sign[worst] = True, -np.sign(slope[worst])
    return x


def cell_scores(cells: np.ndarray, metric: str) -> np.ndarray:
    """F1 per row of (00, 01, 10, 11): of the positive class (``fMeasureByLabel``), or the weighted mean (``f1``)."""
    tn, fp, fn, tp = cells.T

    def f1(hit, said_wrong, missed):
        whole = 2 * hit + said_wrong + missed
        return np.divide(2 * hit, whole, out=np.zeros_like(hit), where=whole > 0)

    positive = f1(tp, fp, fn)
    if metric == "fMeasureByLabel":
        return positive
    return ((tp + fn) * positive + (tn + fp) * f1(tn, fn, fp)) / np.maximum(cells.sum(axis=1), 1)


@dataclass
class ElasticFit:
    """Outcome of :func:`fit_elastic_models`."""

    rows: DataFrame
    names: list[str]
    models: Models
    scores: DataFrame   # (model, params, fold, score)
    best: int           # of the points
    name: str

    @property
    def grid(self) -> DataFrame:
        """(model, params, mean_score, spread, rank) per point, best first."""
        return ranked(self.scores)

    def coefficients(self, point: int | None = None, fold: int = WHOLE) -> np.ndarray:
        """Intercept and coefficients of a point, the best if none is named."""
        return self.models.weights[self.models.model(self.best if point is None else point, fold)]

    def coefficient_table(self, ascending: bool = False) -> DataFrame:
        """(place, feature, coefficient, abs_coefficient, colour) of the best point, by absolute value."""
        rows = list(zip(self.names, map(float, self.coefficients()[1:])))
        rows.sort(key=lambda r: (round(abs(r[1]), 8) * (1 if ascending else -1), r[0]))
        coefs = self.rows.sparkSession.createDataFrame(
            [(i, *r) for i, r in enumerate(rows)], "place int, feature string, coefficient double")
        return coefs.select("place", "feature", "coefficient", F.abs("coefficient").alias("abs_coefficient"),
                            sign_colour(F.col("coefficient")).alias("colour"))

    def certificate(self, point: int | None = None) -> DataFrame:
        """(feature, coefficient, gradient, lasso, distance) of a point: how far 0 is from each subgradient.

        Computed anew from the rows and the coefficients by a plain aggregate.
        """
        m = self.models.model(self.best if point is None else point)
        w, lasso, ridge = self.models.weights[m], self.models.lasso[m], self.models.ridge[m]
        train = self.rows.where(F.col("split") == "train")
        margin = F.lit(float(w[0])) + F.aggregate(
            F.zip_with("x", F.array(*[F.lit(float(v)) for v in w[1:]]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        away = train.select(F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("x"))).alias("j", "v"),
                            (1 / (1 + F.exp(-margin)) - F.col("label")).alias("r"))
        slopes = away.groupBy("j").agg(F.avg(F.col("v") * F.col("r")).alias("slope"))
        rows = [(j, n, float(w[j]), float(lasso[j]), float(ridge[j])) for j, n in enumerate(["(intercept)", *self.names])]
        known = self.rows.sparkSession.createDataFrame(rows, "j int, feature string, coefficient double, lasso double, ridge double")
        gradient = F.col("slope") + F.col("ridge") * F.col("coefficient")
        sign = F.signum("coefficient")
        return known.join(slopes, "j").select(
            "feature", "coefficient", gradient.alias("gradient"), "lasso",
            F.when(sign != 0, F.abs(gradient + F.col("lasso") * sign))
            .otherwise(F.greatest(F.abs(gradient) - F.col("lasso"), F.lit(0.0))).alias("distance"))

    @property
    def predictions(self) -> DataFrame:
        """(key, label, prediction, probability) of the test part by the best point."""
        key = self.rows.columns[0]
        w = self.coefficients()
        margin = F.lit(float(w[0])) + F.aggregate(
            F.zip_with("x", F.array(*[F.lit(float(v)) for v in w[1:]]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return (self.rows.where(F.col("split") == "test").select(key, F.col("label").cast("int").alias("label"), margin.alias("margin"))
                .select(key, "label", (F.col("margin") > 0).cast("int").alias("prediction"),
                        (1 / (1 + F.exp(-F.col("margin")))).alias("probability")))

    def summary(self) -> DataFrame:
        """One row: the best point and its hold-out scores."""
        scores = modelling.classification_metrics(self.predictions)
        return scores.select(
            F.lit(self.name).alias("model"), F.lit(self.models.points[self.best].params).alias("params"),
            F.lit(self.models.n_train).cast("bigint").alias("n_train"), F.col("n_rows").alias("n_test"),
            "f1_weighted", "f1_positive", "accuracy", "error")


def fit_elastic_models(table: DataFrame, points: Sequence[Point], folds: int = 3, test_percent: int = 25,
                       fit_scope: str = "train", metric: str = "f1", standardised: bool = True,
                       name: str = "logistic", scores: ScoreTable | None = None) -> ElasticFit:
    """Split, scale, fit every point on every fold and on the whole training part, score, choose.

    ``standardised`` weighs the penalty of a feature by its spread in the rows
    of the fit, as :class:`pyspark.ml.classification.LogisticRegression` does
    unless told otherwise. Ties go to the earlier point. With ``scores`` the
    score of each point and fold is kept there as well.
    """
    rows, names = prepared(table, folds, test_percent, fit_scope)
    models = Models(rows, points, folds, standardised)
    models.solve()
    values = cell_scores(models.held_out_cells(), metric)
    held = np.flatnonzero(models.fold != WHOLE)
    found = [(name, points[models.point[m]].params, int(models.fold[m]), 0, float(values[m])) for m in held.tolist()]
    if scores is not None:
        scores.add(found)
    means = [round(float(values[held][models.point[held] == p].mean()), 12) for p in range(len(points))]
    kept = table.sparkSession.createDataFrame(found, ScoreTable.SCHEMA).drop("round")
    return ElasticFit(rows, names, models, kept, int(np.argmax(means)), name)
