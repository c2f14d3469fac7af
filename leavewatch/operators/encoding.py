"""Label lists and one-hot columns for the categories of the log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from leavewatch import fixed_values as fixed
from leavewatch.functions.text import cleaned_user_agent
from leavewatch.operators.ranking import with_position

Labels = dict[str, list[str]]


def label_counts(log: DataFrame, columns: Sequence[str] = tuple(fixed.ENCODED_COLUMNS),
                 clean_agents: bool = False) -> DataFrame:
    """Rows per (column, label), for all columns in one pass over the log.

    Each event becomes a row per column and is counted at once, so a task holds
    as many counts as there are labels, not combinations of them.
    ``clean_agents`` takes a log with raw browser strings and cleans them after
    that, so the regular expressions run once per distinct string and not once
    per event.
    """
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label"))
        for c in columns
    ])
    counts = (log.select(F.inline(pairs)).groupBy("column", "label")
              .agg(F.count(F.lit(1)).alias("n_events")))
    if clean_agents and "userAgent" in columns:
        cleaned = F.coalesce(cleaned_user_agent(F.col("label")), F.lit(fixed.UNKNOWN))
        label = F.when(F.col("column") == "userAgent", cleaned).otherwise(F.col("label"))
        counts = (counts.withColumn("label", label).groupBy("column", "label")
                  .agg(F.sum("n_events").alias("n_events")))
    return counts.where(F.col("label").isNotNull())


def label_index(counts: DataFrame) -> DataFrame:
    """Add ``label_rank``: 0 for the most frequent label, ties by name.

    Works for any number of labels; see :mod:`leavewatch.operators.ranking`.
    """
    ranked = with_position(counts, "column", F.desc("n_events"), "label")
    first = ranked.groupBy("column").agg(F.min("position").alias("_first"))
    # One row per encoded column: a handful.
    return (ranked.join(F.broadcast(first), "column")
            .select("column", "label", "n_events",
                    (F.col("position") - F.col("_first")).alias("label_rank")))


def fit_labels(log: DataFrame, columns: Sequence[str] = tuple(fixed.ENCODED_COLUMNS),
               max_labels: int | None = None, clean_agents: bool = False) -> Labels:
    """Labels per column, most frequent first, on the driver.

    One column of output per label needs the labels on the driver. A caller
    who cannot use more than ``max_labels`` gets an error beyond it, never a
    silent cut; the long form
    (:func:`leavewatch.operators.users.user_agent_features`) holds any number.
    """
    counts = label_counts(log, columns, clean_agents)
    if max_labels is not None:
        counts = counts.limit(max_labels + 1)
    rows = counts.collect()
    if max_labels is not None and len(rows) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {', '.join(columns)}")
    rows.sort(key=lambda r: (-r["n_events"], r["label"]))
    return {c: [r["label"] for r in rows if r["column"] == c] for c in columns}


def one_hot_names(labels: Labels) -> list[str]:
    """Output columns in order: ``column_label``; browsers go by rank."""
    return [
        f"{column}_{rank if column == 'userAgent' else label}"
        for column, values in labels.items()
        for rank, label in enumerate(values)
    ]


def one_hot_events(log: DataFrame, labels: Labels) -> DataFrame:
    """The log with each category replaced by one 0/1 double per label.

    The cancellation page's column is called ``cancelled``: it is the label of
    the later model. A null category gives 0 everywhere.
    """
    kept = [c for c in log.columns if c not in labels]
    # Each category is looked up once; the flags then compare small numbers.
    places = {
        column: F.coalesce(F.array_position(F.array(*[F.lit(v) for v in values]),
                                            F.col(column).cast("string")), F.lit(0))
        for column, values in labels.items() if values
    }
    placed = log.select(*kept, *[place.alias(f"_{c}") for c, place in places.items()])
    names = iter(one_hot_names(labels))
    flags = [
        f"CAST(`_{column}` = {place} AS DOUBLE) AS `{next(names)}`"
        for column, values in labels.items()
        for place in range(1, len(values) + 1)
    ]
    return (placed.selectExpr(*[f"`{c}`" for c in kept], *flags)
            .withColumnRenamed(f"page_{fixed.LABEL_PAGE}", "cancelled"))


def one_hot_pipeline(columns: Sequence[str] = tuple(fixed.ENCODED_COLUMNS),
                     output: str = "onehot_features") -> Pipeline:
    """The same encoding as ML stages, giving one vector column.

    All indexers are one stage, so that fitting takes one pass.
    """
    indexed = [f"{c}_indexed" for c in columns]
    encoded = [f"{c}_encoded" for c in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=indexed),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=False),
        VectorAssembler(inputCols=encoded, outputCol=output),
    ])


def pipeline_labels(model, columns: Sequence[str] = tuple(fixed.ENCODED_COLUMNS)) -> Labels:
    return dict(zip(columns, (list(v) for v in model.stages[0].labelsArray)))


def unpack_vector(df: DataFrame, vector: str, names: Sequence[str],
                  keep: Sequence[str]) -> DataFrame:
    """Vector elements as named double columns, without leaving the JVM."""
    unpacked = df.select(*keep, vector_to_array(vector).alias("_v"))
    return unpacked.select(*keep, *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])
