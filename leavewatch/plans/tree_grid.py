"""Gradient-boosted trees over a grid of depths and node sizes, scored after every round.

Each (depth, node size, fold) is one boosted fit, whose held-out rows are scored
by every prefix of its trees. Where the training part has at most
``FIT_VALUES`` values a fit is one task (:mod:`leavewatch.plans.task_trees`) and
counts those rows as its trees grow. Beyond, Spark's learner deals out the rows
and works level by level; then each row's leaf numbers come from the fitted
model, and sums over their values are the margins round by round. Rows of a
finished fit go to the score table at once, so a lost job goes on where it was.
Depths are tried from the least: where no tree reaches the limit, greater
limits give the same trees, and share the fit.

With ``stop_percent`` a part of each fit's own training rows, fixed by the key,
decides when more rounds no longer help; the held-out rows never do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.numeric import hash_percent
from leavewatch.plans import modelling
from leavewatch.plans.elastic_net import cell_scores, prepared
from leavewatch.plans.score_table import ScoreTable, ranked, staged_means
from leavewatch.plans.task_trees import TaskGBT
from leavewatch.sources.shared_storage import cut_lineage

NAME = "trees"
ROUNDS = 100
TASK_VALUES = 1 << 20  # rows x features in a task of a fit; never more tasks than the stored table has parts
FIT_VALUES = 1 << 25  # rows x features that one task fits, 256 MB before they are cut into bins
_LEAF = re.compile(r"^\s*Predict: (\S+)", re.M)
_TREE = re.compile(r"^\s*Tree \d+ \(weight (\S+)\):$", re.M)


@dataclass(frozen=True)
class TreePoint:
    """Depth limit and smallest node that may be split."""

    depth: int
    split_size: int

    @property
    def params(self) -> str:
        return f"max_depth={self.depth}, min_samples_split={self.split_size}"

    @property
    def spark_depth(self) -> int:
        return min(self.depth, modelling.MAX_TREE_DEPTH)

    @property
    def least_child(self) -> int:
        """Spark bounds the rows of a child: half of the split size keeps every smaller node whole."""
        return math.ceil(self.split_size / 2)


def tree_points(depths: Sequence[int] | None = None, split_sizes: Sequence[int] | None = None) -> list[TreePoint]:
    return [TreePoint(d, s) for d in depths or fixed.TREE_DEPTHS for s in split_sizes or fixed.TREE_SPLIT_SIZES]


def leaf_values(model: GBTClassificationModel) -> list[np.ndarray]:
    """Per tree what each leaf adds to the margin, in the order of leaf numbers."""
    told = model.toDebugString
    heads = list(_TREE.finditer(told))
    ends = [h.start() for h in heads[1:]] + [len(told)]
    return [float(h.group(1)) * np.array([float(v) for v in _LEAF.findall(told[h.end():end])]) for h, end in zip(heads, ends)]


def staged_cells(model: GBTClassificationModel, rows: DataFrame) -> np.ndarray:
    """Rows by (label, prediction) as (00, 01, 10, 11), one line per prefix of the trees; one pass."""
    values, n = leaf_values(model), model.getNumTrees

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((n, 4), dtype=np.int64)
        for batch in batches:
            hit = np.asarray(batch.column(0)) > 0.5
            leaves = np.asarray(batch.column(1).flatten()).reshape(len(hit), n).astype(np.int64)
            margins = np.cumsum(np.column_stack([v[leaves[:, i]] for i, v in enumerate(values)]), axis=1)
            said = margins > 0
            cells += np.column_stack([(said[hit == a] == b).sum(axis=0) for a in (False, True) for b in (False, True)])
        place = np.repeat(np.arange(n, dtype=np.int32), 4), np.tile(np.arange(4, dtype=np.int32), n)
        yield pa.RecordBatch.from_arrays([*map(pa.array, place), pa.array(cells.ravel())], ["round", "cell", "n"])

    leaves = model.copy().setLeafCol("leaves").transform(rows).select("label", vector_to_array("leaves").alias("leaves"))
    sums = leaves.mapInArrow(count, "round int, cell int, n long").groupBy("round", "cell").agg(F.sum("n").alias("n"))
    out = np.zeros((n, 4))
    for r in sums.collect():
        out[r["round"], r["cell"]] = r["n"]
    return out


def learner(point: TreePoint, rounds: int, kind: type[GBTClassifier] = GBTClassifier) -> GBTClassifier:
    return kind(labelCol="label", featuresCol="features", maxIter=rounds, maxDepth=point.spark_depth,
                minInstancesPerNode=point.least_child, seed=42)


@dataclass
class TreeFit:
    """Outcome of :func:`fit_tree_models`."""

    scores: ScoreTable
    points: list[TreePoint]
    n_fits: int
    rows: DataFrame
    n_rounds: int = ROUNDS
    name: str = NAME

    def _own(self, df: DataFrame) -> DataFrame:
        return df.where((F.col("model") == NAME) & F.col("params").isin([p.params for p in self.points]))

    @property
    def grid(self) -> DataFrame:
        """(model, params, n_folds, mean_score, spread, rank) per point, best first."""
        return ranked(self._own(self.scores.read()))

    @property
    def rounds(self) -> DataFrame:
        """(model, params, round, mean_score): what every number of rounds scores."""
        return staged_means(self._own(self.scores.staged()))

    @property
    def best(self) -> TreePoint:
        """Of equal points the first in the grid."""
        first = {r["params"] for r in self.grid.where("rank = 1").select("params").collect()}
        return next(p for p in self.points if p.params in first)

    @property
    def predictions(self) -> DataFrame:
        """(key, label, prediction, probability) of the test part by the best point, fitted on the whole training part.

        With as many rounds as score best over the folds.
        """
        best = self.best
        order = self.rounds.where(F.col("params") == best.params).orderBy(F.desc("mean_score"), "round")
        rows = self.rows.withColumn("features", array_to_vector("x"))
        model = learner(best, order.head()["round"]).fit(rows.where(F.col("split") == "train"))
        return model.transform(rows.where(F.col("split") == "test")).select(
            rows.columns[0], F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("probability"))

    def summary(self) -> DataFrame:
        """One row: the best point and its hold-out scores."""
        scores = modelling.classification_metrics(self.predictions)
        n_train = self.rows.where(F.col("split") == "train").count()
        return scores.select(F.lit(NAME).alias("model"), F.lit(self.best.params).alias("params"),
                             F.lit(n_train).cast("bigint").alias("n_train"), F.col("n_rows").alias("n_test"),
                             "f1_weighted", "f1_positive", "accuracy", "error")


def fit_tree_models(table: DataFrame, points: Sequence[TreePoint], scores: ScoreTable, folds: int = 5,
                    rounds: int = ROUNDS, test_percent: int = 25, metric: str = "fMeasureByLabel",
                    stop_percent: int = 0, parallelism: int = 8, key: str = modelling.KEY) -> TreeFit:
    """Fit and score what the score table does not have yet."""
    rows, columns = prepared(table, folds, test_percent)
    stops = hash_percent(F.col(key), "stop:") < stop_percent
    train = cut_lineage(rows.where(F.col("split") == "train").select(
        "label", "fold", stops.alias("stops"), array_to_vector("x").alias("features")))
    n_rows = modelling.check_folds(train, folds)
    in_task = n_rows * len(columns) <= FIT_VALUES
    # Else every tree level is a job; of a small table its time goes into starting tasks, and other fits can use the cores.
    train = train.coalesce(max(1, -(-n_rows * len(columns) // TASK_VALUES)))
    known = scores.done(NAME)
    by_size = {s: sorted((p for p in points if p.split_size == s), key=lambda p: p.depth) for s in {p.split_size for p in points}}
    chains = [(own, fold) for _, own in sorted(by_size.items()) for fold in range(folds)]

    def fit(point: TreePoint, fold: int) -> tuple[list[float], bool]:
        """Score after each round, and whether a deeper limit would change anything."""
        boosted = learner(point, rounds, TaskGBT if in_task else GBTClassifier)
        if stop_percent:
            boosted = boosted.setValidationIndicatorCol("stops")
        if in_task:
            staged = boosted.fit(train.withColumn("held", F.col("fold") == fold))
            return cell_scores(staged.cells, metric).tolist(), bool(staged.full.any())
        model = boosted.fit(train.where(F.col("fold") != fold))
        cells = staged_cells(model, train.where(F.col("fold") == fold))
        reached = max(tree.depth for tree in model.trees)
        return cell_scores(cells, metric).tolist(), reached >= point.spark_depth

    def chain(job: tuple[list[TreePoint], int]) -> int:
        own, fold, fitted, found, limited = *job, 0, None, True
        for point in own:
            if (point.params, fold) in known:
                found, limited = None, True
                continue
            if limited or found is None:
                found, limited = fit(point, fold)
                fitted += 1
            scores.add([(NAME, point.params, fold, i + 1, s) for i, s in enumerate(found)])
        return fitted

    with ThreadPoolExecutor(parallelism) as threads:
        fitted = sum(threads.map(chain, chains))
    return TreeFit(scores, list(points), fitted, rows, rounds)
