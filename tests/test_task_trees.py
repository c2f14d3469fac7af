"""Boosted trees grown within a task, against Spark's learner."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from leavewatch.functions.numeric import hash_percent
from leavewatch.plans import elastic_net, task_trees, tree_grid
from leavewatch.plans.score_table import ScoreTable
from leavewatch.sources.shared_storage import cut_lineage, fresh_path


@pytest.fixture(scope="module")
def rows(features):
    found, _ = elastic_net.prepared(features, 3)
    stops = hash_percent(F.col("userId"), "stop:") < 30
    return cut_lineage(found.select("label", "fold", stops.alias("stops"), array_to_vector("x").alias("features"))).coalesce(1)


@pytest.mark.parametrize("depth, size, stopping", [(2, 2, False), (5, 8, False), (20, 2, False), (5, 2, True)])
def test_rounds_are_those_of_sparks_learner(rows, depth, size, stopping):
    point, both = tree_grid.TreePoint(depth, size), []
    for kind in (tree_grid.GBTClassifier, task_trees.TaskGBT):
        learner = tree_grid.learner(point, 12, kind)
        both.append(learner.setValidationIndicatorCol("stops") if stopping else learner)
    model = both[0].fit(rows.where("fold <> 0"))
    found = both[1].fit(rows.withColumn("held", F.col("fold") == 0))
    assert found.cells.tolist() == tree_grid.staged_cells(model, rows.where("fold = 0")).tolist()
    assert found.full.any() == (max(tree.depth for tree in model.trees) == depth)


def test_jobs_of_a_search_do_not_grow_with_rounds_and_levels(features, spark):
    tracker, made = spark.sparkContext.statusTracker(), []
    for depth, rounds in ((2, 2), (6, 12)):
        first = max(tracker.getJobIdsForGroup(None), default=-1)
        tree_grid.fit_tree_models(features, [tree_grid.TreePoint(depth, 2)], ScoreTable(spark, fresh_path(spark, "scores")), folds=2, rounds=rounds)
        made.append(max(tracker.getJobIdsForGroup(None)) - first)
    assert made[0] == made[1]


def test_a_table_beyond_one_task_has_the_same_scores(features, spark, monkeypatch):
    scores = []
    for most in (tree_grid.FIT_VALUES, 0):
        monkeypatch.setattr(tree_grid, "FIT_VALUES", most)
        fit = tree_grid.fit_tree_models(features, tree_grid.tree_points([2, 4], [8]), ScoreTable(spark, fresh_path(spark, "scores")), folds=2, rounds=3)
        scores.append([tuple(r) for r in fit.scores.staged().orderBy("params", "fold", "round").collect()])
    assert scores[0] == scores[1] and len(scores[0]) == 12


def made_table(n: int):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.exponential(size=n).round(1), np.ones(n)])
    label = (x[:, 0] + x[:, 1] + rng.normal(size=n) > 2.5).astype(float)
    return task_trees.binned(label, rng.integers(0, 3, n), [x[:n // 3], x[n // 3:]], 32)


def test_histograms_in_parts_give_the_same_trees(monkeypatch):
    found = []
    for cells in (task_trees._CELLS, 100):
        monkeypatch.setattr(task_trees, "_CELLS", cells)
        table, sign, stops, held = made_table(2000)
        counts, full = task_trees.boosted_cells(table, sign, stops, held, 8, 12, 1, 0.1, 0.01)
        found.append((counts.tolist(), full.tolist()))
        assert (counts.sum(axis=1) == held.indices(len(sign))[1] - held.start).all()
    assert found[0] == found[1]


def test_split_points_are_the_nearest_to_even_shares():
    rng = np.random.default_rng(5)
    for values in (rng.normal(size=700), rng.poisson(30, 5000) / 7, rng.exponential(size=300).round(2), np.r_[np.zeros(900), rng.normal(size=200)]):
        found, counts = np.unique(values, return_counts=True)
        seen, goal, plain = counts[0], len(values) / 32, []
        for i in range(1, len(found)):
            if abs(seen - goal) < abs(seen + counts[i] - goal):
                plain.append((found[i - 1] + found[i]) / 2)
                goal += len(values) / 32
            seen += counts[i]
        assert task_trees.split_points(values, 32).tolist() == plain
    assert task_trees.split_points(np.ones(50), 32).tolist() == []
    assert task_trees.split_points(np.array([3.0, 1.0, 1.0]), 32).tolist() == [2.0]


def test_what_sparks_learner_refuses_is_an_error():
    label, kind, x = np.array([0.0, 1.0, 1.0, 0.0]), np.array([0, 0, 1, 2]), np.arange(8.0).reshape(4, 2)
    task_trees.binned(label, kind, [x], 32)
    for bad in ((label * 2, kind, x), (np.where(label > 0, np.nan, label), kind, x), (label, kind, np.where(x > 6, np.nan, x)),
                (label, kind, np.where(x > 6, np.inf, x)), (label, kind + 1, x)):
        with pytest.raises(ValueError):
            task_trees.binned(*bad[:2], [bad[2]], 32)


@pytest.mark.parametrize("depth, least", [(4, 1), (9, 5)])
def test_differences_of_siblings_are_their_sums(monkeypatch, depth, least):
    """With targets whose sums are exact, trees are the same whichever way histograms are made."""
    said = []
    for most in (task_trees._IN_ORDER, 0):
        monkeypatch.setattr(task_trees, "_IN_ORDER", most)
        table, sign, *_ = made_table(3000)
        said.append([table.grown(np.round(target * 64) / 64, depth, least) for target in (sign[:table.n_train], table.codes[0, :table.n_train] * sign[:table.n_train])])
    for (a, full), (b, same_full) in zip(*said):
        assert a.tolist() == b.tolist() and full == same_full
