"""Staged scores of boosted trees, and a search that goes on where it was."""

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leavewatch.plans import elastic_net, modelling, tree_grid
from leavewatch.plans.score_table import ScoreTable, ranked
from leavewatch.sources.shared_storage import fresh_path


@pytest.fixture(scope="module")
def rows(features):
    found, _ = elastic_net.prepared(features, 2)
    return found.withColumn("features", array_to_vector("x"))


def table(spark):
    return ScoreTable(spark, fresh_path(spark, "scores"))


def test_every_prefix_scores_like_a_model_of_that_many_rounds(rows):
    train, held = rows.where("fold = 0"), rows.where("fold = 1")
    whole = GBTClassifier(maxIter=6, maxDepth=3, seed=42).fit(train)
    cells = tree_grid.staged_cells(whole, held)
    assert cells.shape == (6, 4) and (cells.sum(axis=1) == held.count()).all()
    for n in (1, 3, 6):
        short = GBTClassifier(maxIter=n, maxDepth=3, seed=42).fit(train).transform(held)
        found = {(int(r["label"]), int(r["prediction"])): r["count"] for r in short.groupBy("label", "prediction").count().collect()}
        assert cells[n - 1].tolist() == [found.get((a, b), 0) for a in (0, 1) for b in (0, 1)]


def test_scores_are_the_f1_of_the_held_out(features, rows, spark):
    point = tree_grid.TreePoint(2, 2)
    fit = tree_grid.fit_tree_models(features, [point], table(spark), folds=2, rounds=4, metric="f1")
    train = fit.rows.where("split = 'train'").withColumn("features", array_to_vector("x"))
    for fold in (0, 1):
        model = GBTClassifier(maxIter=4, maxDepth=2, minInstancesPerNode=1, seed=42).fit(train.where(F.col("fold") != fold))
        said = model.transform(train.where(F.col("fold") == fold)).select("label", "prediction")
        score, = fit.scores.read().where(F.col("fold") == fold).collect()
        assert score["score"] == pytest.approx(modelling.classification_metrics(said).head()["f1_weighted"])
    assert fit.rounds.count() == 4
    held_out = fit.summary().head()
    assert held_out["n_train"] == train.count() and 0 <= held_out["accuracy"] <= 1
    assert fit.predictions.count() == held_out["n_test"] == features.count() - train.count()


def test_deeper_limits_share_a_fit_that_no_tree_fills(features, spark):
    points = tree_grid.tree_points([2, 20, 100], [32])
    fit = tree_grid.fit_tree_models(features, points, table(spark), folds=2, rounds=3)
    assert fit.n_fits <= 4
    by_point = {r["params"]: r["mean_score"] for r in fit.grid.collect()}
    assert by_point["max_depth=20, min_samples_split=32"] == by_point["max_depth=100, min_samples_split=32"]
    alone = tree_grid.fit_tree_models(features, [tree_grid.TreePoint(100, 32)], table(spark), folds=2, rounds=3)
    assert alone.grid.head()["mean_score"] == by_point["max_depth=100, min_samples_split=32"]


def test_a_lost_job_goes_on_where_it_was(features, spark, monkeypatch):
    points, scores = tree_grid.tree_points([2, 4], [2]), table(spark)
    learned, fit_once = [], GBTClassifier.fit

    def fails_at_third(self, *given):
        learned.append(1)
        if len(learned) == 3:
            raise RuntimeError("executor lost")
        return fit_once(self, *given)

    monkeypatch.setattr(GBTClassifier, "fit", fails_at_third)
    with pytest.raises(RuntimeError, match="lost"):
        tree_grid.fit_tree_models(features, points, scores, folds=2, rounds=2, parallelism=1)
    assert len(scores.done(tree_grid.NAME)) == 2
    again = tree_grid.fit_tree_models(features, points, scores, folds=2, rounds=2, parallelism=1)
    assert again.n_fits == 2 and again.grid.count() == 2
    assert tree_grid.fit_tree_models(features, points, scores, folds=2, rounds=2).n_fits == 0
    whole = tree_grid.fit_tree_models(features, points, table(spark), folds=2, rounds=2)
    assert [tuple(r) for r in whole.grid.collect()] == [tuple(r) for r in again.grid.collect()]


def test_early_stop_never_looks_at_the_held_out(features, spark):
    """Other labels of a held-out fold change its score, and no round of its fit."""
    point, n = tree_grid.TreePoint(2, 2), 30
    first, second = table(spark), table(spark)
    tree_grid.fit_tree_models(features, [point], first, folds=2, rounds=n, stop_percent=30)
    fold = modelling.with_fold(features, 2)
    turned = fold.withColumn("cancelled", F.when(F.col("fold") == 0, 1 - F.col("cancelled")).otherwise(F.col("cancelled"))).drop("fold")
    tree_grid.fit_tree_models(turned, [point], second, folds=2, rounds=n, stop_percent=30)
    last = [{r["fold"]: r["n"] for r in s.staged().groupBy("fold").agg(F.max("round").alias("n")).collect()} for s in (first, second)]
    assert last[0][0] == last[1][0] < n


def test_tasks_of_a_fit_follow_the_training_table(features, spark, monkeypatch):
    """Few for a small table, as many as it is stored in for a large one; the scores are the same."""
    parts, fit_once = [], GBTClassifier.fit

    def counted(self, data):
        parts.append(data.rdd.getNumPartitions())
        return fit_once(self, data)

    monkeypatch.setattr(GBTClassifier, "fit", counted)
    split, point = features.repartition(6), tree_grid.TreePoint(2, 2)
    few = tree_grid.fit_tree_models(split, [point], table(spark), folds=2, rounds=2)
    assert parts == [1, 1]
    parts.clear()
    monkeypatch.setattr(tree_grid, "TASK_VALUES", 1)
    many = tree_grid.fit_tree_models(split, [point], table(spark), folds=2, rounds=2)
    assert parts == [6, 6]
    scores = [[(r["fold"], r["score"]) for r in f.scores.read().orderBy("fold").collect()] for f in (few, many)]
    assert [s[0] for s in scores[0]] == [s[0] for s in scores[1]]
    assert [s[1] for s in scores[0]] == pytest.approx([s[1] for s in scores[1]])


def test_both_estimators_in_one_ranking(features, spark):
    scores = table(spark)
    elastic_net.fit_elastic_models(features, elastic_net.penalty_points({"elasticNetParam": [0.5], "regParam": [0.1]}), folds=2, scores=scores)
    tree_grid.fit_tree_models(features, [tree_grid.TreePoint(2, 2)], scores, folds=2, rounds=2, metric="f1")
    both = ranked(scores.read()).collect()
    assert {r["model"] for r in both} == {"logistic", "trees"} and [r["n_folds"] for r in both] == [2, 2]
    means = [r["mean_score"] for r in both]
    assert means == sorted(means, reverse=True)


def test_staged_means_carry_the_last_score(spark):
    scores = table(spark)
    own = tree_grid.TreePoint(2, 2).params
    scores.add([("trees", own, 0, 1, 0.2), ("trees", own, 0, 2, 0.4), ("trees", own, 1, 1, 0.6), ("trees", "other", 1, 1, 0.9)])
    fit = tree_grid.TreeFit(scores, [tree_grid.TreePoint(2, 2)], 0, None)
    assert {r["round"]: r["mean_score"] for r in fit.rounds.collect()} == {1: pytest.approx(0.4), 2: pytest.approx(0.5)}


def test_whole_grid_is_tried():
    points = tree_grid.tree_points()
    assert len(points) == 20 and {p.spark_depth for p in points} == {2, 5, 10, 20, 30}
    assert {p.least_child for p in points} == {1, 4, 8, 16}
    assert len({p.params for p in points}) == 20
