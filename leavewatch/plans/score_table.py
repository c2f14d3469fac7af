"""Scores of a model search by point, fold and round, kept as fits end.

A search that is started again with the same table reads what is there and
fits only what is missing. Each fit adds its rows as one committed write, so a
lost job leaves all of its rows or none; a row that two jobs wrote counts once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

Score = tuple[str, str, int, int, float]


class ScoreTable:
    """(model, params, fold, round, score) under a path that all jobs of the search share.

    A model that is built in rounds has a row for each; others have round 0.
    """

    SCHEMA = "model string, params string, fold int, round int, score double"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, rows: Iterable[Score]) -> None:
        """One file in a folder of its own: jobs that add at the same time do not meet."""
        self.spark.createDataFrame(list(rows), self.SCHEMA).coalesce(1).write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def staged(self) -> DataFrame:
        """One row per (model, params, fold, round)."""
        try:
            found = self.spark.read.schema(self.SCHEMA).option("recursiveFileLookup", True).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], self.SCHEMA)
        return found.groupBy("model", "params", "fold", "round").agg(F.min("score").alias("score"))

    def read(self) -> DataFrame:
        """(model, params, fold, score): the score after the last round."""
        return self.staged().groupBy("model", "params", "fold").agg(F.max_by("score", "round").alias("score"))

    def done(self, model: str) -> set[tuple[str, int]]:
        """(params, fold) of the model's fits that are there: as many as the search has fits."""
        rows = self.staged().where(F.col("model") == model).select("params", "fold").distinct().collect()
        return {(r["params"], r["fold"]) for r in rows}


def ranked(scores: DataFrame) -> DataFrame:
    """(model, params, n_folds, mean_score, spread, rank) per point over all estimators, best first.

    ``spread`` is the sample standard deviation over the folds; equal means
    share a rank. Means are compared to 12 digits, below what the order of
    sums can change.
    """
    points = scores.groupBy("model", "params").agg(
        F.count(F.lit(1)).alias("n_folds"), F.round(F.avg("score"), 12).alias("mean_score"),
        F.stddev_samp("score").alias("spread"))
    # One row per grid point.
    place = F.rank().over(Window.orderBy(F.desc("mean_score"))).cast("int")
    return points.withColumn("rank", place).orderBy("rank", "model", "params")


def staged_means(staged: DataFrame) -> DataFrame:
    """(model, params, round, mean_score) over the folds; a fit that ended early keeps its last score."""
    fits = staged.groupBy("model", "params", "fold").agg(
        F.sort_array(F.collect_list(F.struct("round", "score"))).alias("rounds"))  # a row per round of one fit
    fits = fits.select("model", "params", "rounds", F.max(F.size("rounds")).over(Window.partitionBy("model", "params")).alias("most"))
    each = fits.select("model", "params", "rounds", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("round"))
    score = F.element_at("rounds", F.least("round", F.size("rounds")))["score"]
    return each.groupBy("model", "params", "round").agg(F.avg(score).alias("mean_score"))
