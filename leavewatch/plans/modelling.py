"""Scaling, splitting, model search and scores on the user table.

The user table is small next to the log. It goes to reliable storage once,
before the many passes of a model search.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.numeric import hash_percent, sign_colour, stable_hash
from leavewatch.sources.shared_storage import cut_lineage

KEY, LABEL = "userId", "cancelled"
MAX_TREE_DEPTH = 30  # the limit of Spark's tree learners


def feature_columns(df: DataFrame, key: str = KEY, label: str = LABEL) -> list[str]:
    """Every column but the key and the label, less any split or fold column."""
    return [c for c in df.columns if c not in (key, label, "split", "fold")]


def minmax_pipeline(columns: Sequence[str], output: str = "scaled_features") -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="features"),
        MinMaxScaler(inputCol="features", outputCol=output),
    ])


def minmax_scaled(df: DataFrame, columns: Sequence[str] | None = None,
                  keep: Sequence[str] = (KEY, LABEL)) -> DataFrame:
    """Columns scaled to [0, 1] under their own names; a constant one gives 0.5.

    Same values as :func:`minmax_pipeline`, as plain arithmetic, where no value
    is null. A null stays null, and so does a column of nulls. Reads the table
    twice, for the bounds and for the values, and so stores it first.
    The bounds, two numbers per column, are constants of the second plan.
    """
    names = list(columns or feature_columns(df))
    df = cut_lineage(df.select(*keep, *names))
    bounds = df.agg(*[F.expr(f"struct(CAST(min(`{c}`) AS DOUBLE), CAST(max(`{c}`) AS DOUBLE))")
                      for c in names]).head()
    scaled = []
    for name, (low, high) in zip(names, bounds):
        if low == high:  # constant, or nothing but nulls
            value = F.when(F.col(name).isNotNull(), 0.5)
        else:
            value = (F.col(name) - low) / (high - low)
        scaled.append(value.alias(name))
    return df.select(*keep, *scaled)


def with_split(df: DataFrame, test_percent: int = 25, key: str = KEY) -> DataFrame:
    """Add ``split``: ``train`` or ``test``, fixed by the key."""
    is_test = hash_percent(F.col(key)) < test_percent
    return df.withColumn("split", F.when(is_test, "test").otherwise("train"))


def with_fold(df: DataFrame, folds: int, key: str = KEY) -> DataFrame:
    """Add ``fold``, fixed by the key and independent of the split."""
    return df.withColumn("fold", (stable_hash(F.col(key), "fold:") % folds).cast("int"))


def base_rate(split: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and share of the label in each part of the split."""
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(label).alias("base_rate"))


@dataclass(frozen=True)
class Search:
    """An estimator and the parameter maps to try with it."""

    name: str
    estimator: Estimator
    grid: list[dict]


def _search(name: str, estimator: Estimator, values: dict[str, Sequence]) -> Search:
    grid = ParamGridBuilder()
    for param, options in values.items():
        grid = grid.addGrid(estimator.getParam(param), list(options))
    return Search(name, estimator, grid.build())


def logistic_search(values: dict[str, Sequence] | None = None,
                    features: str = "scaled_features") -> Search:
    """Elastic-net logistic regression over a grid of penalties."""
    estimator = LogisticRegression(labelCol="label", featuresCol=features,
                                   **fixed.LOGISTIC_DEFAULTS)
    return _search("logistic", estimator, values or fixed.LARGE_LOGISTIC_GRID)


def inverse_strength_search(n_rows: int, strengths: Sequence[float] | None = None,
                            l1_ratios: Sequence[float] | None = None,
                            features: str = "scaled_features") -> Search:
    """The same model with the penalty given as inverse strength C.

    C weighs the summed loss; Spark weighs the penalty against the mean loss,
    so ``regParam = 1 / (C * n_rows)``. Features are not standardised.
    """
    estimator = LogisticRegression(labelCol="label", featuresCol=features,
                                   standardization=False, maxIter=10000)
    penalties = [1.0 / (c * n_rows) for c in strengths or fixed.INVERSE_STRENGTHS]
    ratios = [float(r) for r in l1_ratios or fixed.L1_RATIOS]
    return _search("logistic", estimator, {"regParam": penalties, "elasticNetParam": ratios})


def capped_depths(depths: Sequence[int] = tuple(fixed.TREE_DEPTHS)) -> list[int]:
    """The depths to try, those beyond Spark's limit as the limit."""
    return sorted({min(d, MAX_TREE_DEPTH) for d in depths})


def tree_search(depths: Sequence[int] | None = None, split_sizes: Sequence[int] | None = None,
                rounds: int = 100, features: str = "scaled_features") -> Search:
    """Gradient-boosted trees over depth and smallest splittable node.

    Depths beyond Spark's limit are an error; the caller says what to try
    instead (``capped_depths``). Spark bounds the rows of a child and not of
    the node that is split: half the split size, rounded up, keeps every
    smaller node whole.
    """
    depths = list(depths or capped_depths())
    if max(depths) > MAX_TREE_DEPTH:
        raise ValueError(f"trees can be {MAX_TREE_DEPTH} deep at most")
    estimator = GBTClassifier(labelCol="label", featuresCol=features, maxIter=rounds,
                              maxDepth=5, seed=42)
    children = [math.ceil(s / 2) for s in split_sizes or fixed.TREE_SPLIT_SIZES]
    return _search("trees", estimator, {"maxDepth": depths, "minInstancesPerNode": children})


@dataclass
class ChurnFit:
    """Outcome of :func:`fit_churn_model`."""

    name: str
    model: Model
    features: list[str]
    grid: DataFrame
    predictions: DataFrame
    n_train: int

    def summary(self) -> DataFrame:
        """One row: hold-out scores."""
        scores = classification_metrics(self.predictions)
        return scores.select(F.lit(self.name).alias("model"),
                             F.lit(self.n_train).cast("bigint").alias("n_train"),
                             F.col("n_rows").alias("n_test"),
                             "f1_weighted", "f1_positive", "accuracy", "error")


def check_folds(train: DataFrame, folds: int) -> int:
    """Number of training rows; an error if a fold has none of either class."""
    cells = train.groupBy("fold", "label").count().collect()
    if len({(r["fold"], r["label"]) for r in cells}) < 2 * folds:
        raise ValueError(f"not every one of the {folds} folds holds both classes")
    return sum(r["count"] for r in cells)


def fit_churn_model(table: DataFrame, search: Search, folds: int = 3, test_percent: int = 25,
                    scale: bool = True, fit_scope: str = "train", metric: str = "f1",
                    parallelism: int = 8, key: str = KEY, label: str = LABEL) -> ChurnFit:
    """Split, scale, cross-validate over the grid, refit the best, predict.

    ``fit_scope`` says which rows the scaler sees: ``train``, or ``all``.
    ``metric="f1"`` is the mean over classes weighted by size;
    ``metric="fMeasureByLabel"`` is the F1 of the cancelled class.
    """
    names = feature_columns(table, key, label)
    prepared = with_fold(with_split(table, test_percent, key), folds, key)
    prepared = cut_lineage(prepared.withColumn("label", F.col(label).cast("double")))
    seen = prepared if fit_scope == "all" else prepared.where(F.col("split") == "train")
    if scale:
        vectors = minmax_pipeline(names).fit(seen).transform(prepared)
    else:
        vectors = VectorAssembler(inputCols=names, outputCol="scaled_features").transform(prepared)
    vectors = vectors.select(key, label, "label", "split", "fold", "scaled_features")
    train = vectors.where(F.col("split") == "train")
    n_train = check_folds(train, folds)
    evaluator = MulticlassClassificationEvaluator(metricName=metric, metricLabel=1.0)
    validator = CrossValidator(estimator=search.estimator, estimatorParamMaps=search.grid,
                               evaluator=evaluator, numFolds=folds, foldCol="fold",
                               parallelism=parallelism)
    fitted = validator.fit(train)
    predictions = fitted.bestModel.transform(vectors.where(F.col("split") == "test"))
    predictions = predictions.select(
        key, F.col(label).alias("label"), F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"))
    return ChurnFit(search.name, fitted.bestModel, names,
                    grid_results(table, search, fitted.avgMetrics), predictions, n_train)


def fit_churn_models(table: DataFrame, searches: Sequence[Search], **options) -> list[ChurnFit]:
    return [fit_churn_model(table, search, **options) for search in searches]


def all_grid_results(fits: Sequence[ChurnFit]) -> DataFrame:
    """One row per grid point of every estimator, best mean score first."""
    whole = fits[0].grid
    for fit in fits[1:]:
        whole = whole.unionByName(fit.grid)
    return whole.orderBy(F.desc("mean_score"), "model", "params")


def grid_results(table: DataFrame, search: Search, scores: Sequence[float]) -> DataFrame:
    """One row per grid point, best mean score first."""
    rows = [
        (search.name,
         ", ".join(f"{param.name}={value:g}" for param, value in
                   sorted(point.items(), key=lambda item: item[0].name)),
         float(score))
        for point, score in zip(search.grid, scores)
    ]
    results = table.sparkSession.createDataFrame(
        rows, "model string, params string, mean_score double")
    return results.orderBy(F.desc("mean_score"), "params")


def coefficient_table(fit: ChurnFit, ascending: bool = False) -> DataFrame:
    """Coefficients by feature name, largest absolute value first, with colour."""
    rows = [(name, float(value)) for name, value in zip(fit.features, fit.model.coefficients)]
    spark = fit.predictions.sparkSession
    coefs = spark.createDataFrame(rows, "feature string, coefficient double")
    order = F.asc("abs_coefficient") if ascending else F.desc("abs_coefficient")
    return (coefs.withColumns({"abs_coefficient": F.abs("coefficient"),
                               "colour": sign_colour(F.col("coefficient"))})
            .orderBy(order, "feature"))


def classification_metrics(df: DataFrame, label: str = "label",
                           prediction: str = "prediction", positive: int = 1) -> DataFrame:
    """One row: weighted F1, F1 of one class, accuracy and error.

    Rows are first counted by (label, prediction), so the rest works on a
    table of classes squared.
    """
    cells = (df.groupBy(F.col(label).cast("int").alias("_l"), F.col(prediction).cast("int").alias("_p"))
             .agg(F.count(F.lit(1)).alias("_n")))
    hit = F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("_l").alias("_c"), F.col("_n").alias("_actual"), F.lit(0).alias("_said"),
                 hit.alias("_hit")),
        F.struct(F.col("_p").alias("_c"), F.lit(0).alias("_actual"), F.col("_n").alias("_said"),
                 F.lit(0).alias("_hit")),
    )
    classes = (cells.select(F.inline(sides)).groupBy("_c")
               .agg(*[F.sum(c).alias(c) for c in ("_actual", "_said", "_hit")]))
    f1 = F.coalesce(F.try_divide(2 * F.col("_hit"), F.col("_actual") + F.col("_said")), F.lit(0.0))
    n = F.sum("_actual")
    accuracy = F.try_divide(F.sum("_hit"), n)
    return classes.withColumn("_f1", f1).agg(
        n.alias("n_rows"),
        F.try_divide(F.sum(F.col("_f1") * F.col("_actual")), n).alias("f1_weighted"),
        F.coalesce(F.max(F.when(F.col("_c") == positive, F.col("_f1"))), F.lit(0.0))
        .alias("f1_positive"),
        accuracy.alias("accuracy"),
        (1 - accuracy).alias("error"),
    )
