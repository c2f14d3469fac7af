"""Model fits: finite scores, repeatable results, honest errors."""

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from leavewatch import fixed_values as fixed
from leavewatch.plans import modelling


@pytest.fixture(scope="module")
def fit(features):
    return modelling.fit_churn_model(
        features, modelling.logistic_search(fixed.SMALL_LOGISTIC_GRID), folds=2, test_percent=20)


def test_scores_are_finite_and_consistent(fit, features):
    row = fit.summary().head()
    assert row["n_train"] + row["n_test"] == features.count()
    for name in ("f1_weighted", "f1_positive", "accuracy", "error"):
        assert 0 <= row[name] <= 1
    assert row["accuracy"] + row["error"] == pytest.approx(1)


def test_scores_equal_the_evaluator(fit):
    row = fit.summary().head()
    doubles = fit.predictions.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    for metric, name in [("f1", "f1_weighted"), ("accuracy", "accuracy"),
                         ("fMeasureByLabel", "f1_positive")]:
        evaluator = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0)
        assert row[name] == pytest.approx(evaluator.evaluate(doubles))


def test_grid_is_sorted_and_complete(fit):
    scores = [r["mean_score"] for r in fit.grid.collect()]
    assert len(scores) == 2 and scores == sorted(scores, reverse=True)


def test_coefficients_by_name(fit, features):
    rows = modelling.coefficient_table(fit).collect()
    assert {r["feature"] for r in rows} == set(modelling.feature_columns(features))
    sizes = [r["abs_coefficient"] for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    assert all(r["colour"] == ("red" if r["coefficient"] < 0 else "blue") for r in rows)
    rising = [r["abs_coefficient"] for r in modelling.coefficient_table(fit, True).collect()]
    assert rising == sorted(rising)


def test_same_result_on_a_rerun(fit, features):
    again = modelling.fit_churn_model(
        features.repartition(3), modelling.logistic_search(fixed.SMALL_LOGISTIC_GRID),
        folds=2, test_percent=20)
    first = dict(fit.predictions.select("userId", "probability").collect())
    second = dict(again.predictions.select("userId", "probability").collect())
    assert first.keys() == second.keys()
    assert all(first[u] == pytest.approx(second[u], abs=1e-6) for u in first)


def test_inverse_strength_is_turned_into_a_penalty():
    pass_through = {p.name: v for p, v in
                    modelling.inverse_strength_search(100, [0.1], [0.5]).grid[0].items()}
    assert pass_through == {"regParam": pytest.approx(0.1), "elasticNetParam": 0.5}
    assert len(modelling.inverse_strength_search(100).grid) == 63


def test_elastic_search_scores_the_cancelled(features):
    search = modelling.inverse_strength_search(100, [0.1, 1.0], [0.0, 0.5])
    fit = modelling.fit_churn_model(features, search, folds=2, metric="fMeasureByLabel")
    assert fit.grid.count() == 4 and 0 <= fit.summary().head()["f1_positive"] <= 1


def test_both_estimators_share_one_grid_result(features):
    searches = [modelling.logistic_search(fixed.SMALL_LOGISTIC_GRID), modelling.tree_search([2], [2], rounds=2)]
    grid = modelling.all_grid_results(modelling.fit_churn_models(features, searches, folds=2)).collect()
    assert sorted(r["model"] for r in grid) == ["logistic", "logistic", "trees"]
    assert [r["mean_score"] for r in grid] == sorted((r["mean_score"] for r in grid), reverse=True)


def test_tree_grid_stays_within_limits():
    grid = modelling.tree_search().grid
    values = [{p.name: v for p, v in point.items()} for point in grid]
    assert max(v["maxDepth"] for v in values) == modelling.MAX_TREE_DEPTH
    assert {v["minInstancesPerNode"] for v in values} == {1, 4, 8, 16}
    assert len(grid) == 20


def test_trees_fit_unscaled(features):
    search = modelling.tree_search(depths=[2], split_sizes=[2], rounds=3)
    (fit,) = modelling.fit_churn_models(features, [search], folds=2, scale=False,
                                        metric="fMeasureByLabel")
    assert fit.summary().head()["model"] == "trees"


def test_fold_without_a_class_is_an_error(features):
    with pytest.raises(ValueError, match="both classes"):
        modelling.fit_churn_model(features.withColumn("cancelled", F.lit(0)),
                                  modelling.logistic_search(fixed.SMALL_LOGISTIC_GRID), folds=2)
