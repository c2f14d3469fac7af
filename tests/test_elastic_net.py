"""The joint elastic-net search against separate fits and its own certificate."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leavewatch import fixed_values as fixed
from leavewatch.plans import elastic_net, modelling
from leavewatch.plans.score_table import ScoreTable
from leavewatch.sources.shared_storage import fresh_path


@pytest.fixture(scope="module")
def fit(features):
    return elastic_net.fit_elastic_models(features, elastic_net.penalty_points(), folds=3)


def objective(rows, weights, reg, ratio, standardised):
    x = np.array([r.x for r in rows])
    y = np.array([r.label for r in rows])
    margin = weights[0] + x @ weights[1:]
    scale = x.std(axis=0, ddof=1) if standardised else np.ones(x.shape[1])
    w = weights[1:] * scale
    return (np.logaddexp(0, margin) - y * margin).mean() + reg * (ratio * np.abs(w).sum() + (1 - ratio) / 2 * (w * w).sum())


@pytest.mark.parametrize("standardised", [True, False])
@pytest.mark.parametrize("reg, ratio", [(0.1, 0.0), (0.01, 0.5), (0.01, 1.0)])
def test_objective_is_no_worse_than_a_plain_fit(features, standardised, reg, ratio):
    """Within 1e-6 of Spark's learner where that converges, on a fold and on the whole training part."""
    point = elastic_net.Point("p", ratio, strength=reg)
    found = elastic_net.fit_elastic_models(features, [point], folds=2, standardised=standardised)
    train = found.rows.where("split = 'train'").withColumn("v", array_to_vector("x"))
    for fold in (elastic_net.WHOLE, 0):
        own = train.where(F.col("fold") != fold)
        plain = LogisticRegression(featuresCol="v", regParam=reg, elasticNetParam=ratio, standardization=standardised,
                                   maxIter=1000, tol=1e-11).fit(own)
        rows = own.collect()
        theirs = objective(rows, np.append(plain.intercept, plain.coefficients.toArray()), reg, ratio, standardised)
        ours = objective(rows, found.models.weights[found.models.model(0, fold)], reg, ratio, standardised)
        assert ours <= theirs + 1e-9 and abs(ours - theirs) < 1e-6


def test_every_model_is_optimal(fit):
    assert len(fit.models.violation) == 12 * 4
    assert (fit.models.violation <= elastic_net.ACCEPTED * fit.models.scale).all()


def test_certificate_is_computed_from_the_rows(fit):
    rows = fit.certificate().collect()
    assert len(rows) == len(fit.names) + 1 and max(r.distance for r in rows) < 1e-9
    m = fit.models.model(fit.best)
    kept = fit.models.weights[m].copy()
    fit.models.weights[m, 1] += 0.1
    assert max(r.distance for r in fit.certificate().collect()) > 1e-5
    fit.models.weights[m] = kept


def test_scores_are_those_of_the_predictions(fit):
    """Scores of one point by fold, by the plain metrics of the library."""
    train = fit.rows.where("split = 'train'")
    for fold in range(3):
        w = fit.coefficients(4, fold)
        rows = train.where(F.col("fold") == fold).collect()
        said = [(int(r.label), int(w[0] + np.dot(w[1:], r.x) > 0)) for r in rows]
        guess = fit.rows.sparkSession.createDataFrame(said, "label int, prediction int")
        expected = modelling.classification_metrics(guess).head()["f1_weighted"]
        score, = fit.scores.where((F.col("params") == fit.models.points[4].params) & (F.col("fold") == fold)).collect()
        assert score["score"] == pytest.approx(expected, abs=1e-12)


def test_same_result_however_rows_are_dealt(features, fit):
    again = elastic_net.fit_elastic_models(features.repartition(5, "avg_num_errors"), elastic_net.penalty_points(), folds=3)
    assert np.abs(again.models.weights - fit.models.weights).max() < 1e-6
    assert [tuple(r) for r in again.grid.select("params", "rank").collect()] == [tuple(r) for r in fit.grid.select("params", "rank").collect()]


def test_penalty_by_inverse_strength_counts_the_rows_of_the_fit():
    point, = elastic_net.inverse_strength_points([0.1], [0.5])
    assert point.weight(50) == pytest.approx(0.2) and point.params == "C=0.1, l1_ratio=0.5"
    assert len(elastic_net.inverse_strength_points()) == 63


def test_flat_feature_gets_no_weight(features):
    table = features.withColumns({"flat": F.lit(3.0), "copy": F.col("avg_num_errors")})
    for standardised in (True, False):
        found = elastic_net.fit_elastic_models(table, elastic_net.penalty_points(fixed.SMALL_LOGISTIC_GRID), folds=2, standardised=standardised)
        weights = dict(zip(found.names, found.coefficients()[1:]))
        assert abs(weights["flat"]) < 1e-9
        assert weights["copy"] == pytest.approx(weights["avg_num_errors"], abs=1e-6)


def test_strong_lasso_leaves_the_intercept(features):
    found = elastic_net.fit_elastic_models(features, [elastic_net.Point("p", 1.0, strength=100.0)], folds=2)
    w = found.coefficients()
    rate = found.rows.where("split = 'train'").agg(F.avg("label")).head()[0]
    assert (w[1:] == 0).all() and w[0] == pytest.approx(np.log(rate / (1 - rate)), abs=1e-9)


def test_fold_without_a_class_is_an_error(features):
    with pytest.raises(ValueError, match="both classes"):
        elastic_net.fit_elastic_models(features.withColumn("cancelled", F.lit(0)), elastic_net.penalty_points(), folds=2)


def test_too_many_features_are_an_error(features):
    wide = features.select("userId", "cancelled", *[F.lit(1.0).alias(f"f{i}") for i in range(elastic_net.MAX_FEATURES + 1)])
    with pytest.raises(ValueError, match="features"):
        elastic_net.fit_elastic_models(wide, elastic_net.penalty_points(), folds=2)


@pytest.mark.parametrize("seed", range(20))
def test_quadratic_minimum_has_no_descent(seed):
    r = np.random.default_rng(seed)
    d = 12
    half = r.standard_normal((d, 9 if seed % 2 else 20))
    curvature = half @ half.T + 1e-3 * np.eye(d)
    linear, lasso, free = r.standard_normal(d) * 3, r.choice([0.0, 0.5, 2.0], d), r.random(d) > 0.1
    x = elastic_net.quadratic_minimum(curvature, linear, lasso, r.standard_normal(d), free)
    assert (x[~free] == 0).all()
    assert elastic_net.distance_to_optimum(x[None], (curvature @ x - linear)[None], lasso[None], ~free[None])[0] < 1e-9


def test_score_table_counts_rows_once_and_starts_empty(spark):
    table = ScoreTable(spark, fresh_path(spark, "scores"))
    assert table.done("logistic") == set() and table.read().count() == 0
    table.add([("logistic", "a", 0, 0, 0.5)])
    table.add([("logistic", "a", 0, 0, 0.5), ("logistic", "a", 1, 0, 0.7), ("trees", "a", 0, 1, 0.1), ("trees", "a", 0, 2, 0.3)])
    assert table.done("logistic") == {("a", 0), ("a", 1)}
    assert {tuple(r) for r in table.read().collect()} == {("logistic", "a", 0, 0.5), ("logistic", "a", 1, 0.7), ("trees", "a", 0, 0.3)}
