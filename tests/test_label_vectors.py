"""Sparse label vectors, and correlations from masked products."""

import numpy as np
import pandas as pd
import pytest
from compare import assert_close
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import MEDIUM
from leavewatch.operators import explore, label_vectors
from leavewatch.operators.cleaning import clean_events
from leavewatch.operators.users import browser_user_features
from leavewatch.sources.sample_log import read_sample_log


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hundred_thousand_labels_make_a_model_input(spark):
    """One user holds a third of all events, and as many labels."""
    user = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).cast("string")
    log = spark.range(300_000).select(user.alias("userId"), (F.col("id") % 4).alias("sessionId"),
                                      F.concat(F.lit("l"), F.col("id") % 100_000).alias("label"))
    index = label_vectors.stored_index(log, "label")
    size = index.count()
    assert size == 100_000
    vectors = label_vectors.label_mean_vectors(log, "label", index, size=size)
    told = plan(vectors)
    assert "Pivot" not in told and "pivot" not in told and "Generate" not in told
    long = label_vectors.vector_entries(vectors, "labels", ["userId"])
    expected = (log.groupBy("userId", "label").agg(F.count(F.lit(1)).alias("n"))
                .join(log.groupBy("userId").agg(F.countDistinct("sessionId").alias("s")), "userId").join(index, "label")
                .select("userId", F.col("label_rank").cast("int").alias("place"), (F.col("n") / F.col("s")).alias("value")))
    assert long.exceptAll(expected).isEmpty() and expected.exceptAll(long).isEmpty()

    users = log.groupBy("userId").agg(F.count(F.lit(1)).cast("double").alias("events"), F.max("sessionId").alias("sessions"))
    table = label_vectors.assembled_with(users, vectors, ["events", "sessions"], size)
    first = table.head()
    assert first["features"].size == size + 2 and first["features"][0] == first["events"]
    model = LogisticRegression(maxIter=2, labelCol="y").fit(table.withColumn("y", (F.hash("userId") % 2 == 0).cast("double")))
    assert model.numFeatures == size + 2


def test_odd_labels(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", 1, None), (None, 1, "y"), ("c", 1, "z")]
    log = spark.createDataFrame(rows, "userId string, sessionId long, kind string")
    found = {r["userId"]: r["labels"] for r in label_vectors.label_mean_vectors(log, "kind").collect()}
    assert found["a"].toArray().tolist() == [1, 0, 0] and found["b"].toArray().tolist() == [0, 0, 0]
    assert found["c"].toArray().tolist() == [0, 0, 1]
    known = spark.createDataFrame([("x", 4)], "label string, label_rank long")
    found = {r["userId"]: r["labels"] for r in label_vectors.label_mean_vectors(log, "kind", known).collect()}
    assert found["a"].toArray().tolist() == [0, 0, 0, 0, 1] and found["c"].numNonzeros() == 0
    empty = label_vectors.label_mean_vectors(log.limit(0), "kind")
    assert empty.collect() == [] and label_vectors.vector_entries(empty, "labels", ["userId"]).collect() == []


def test_vectors_equal_the_columns_per_browser(spark, clean_log):
    columns = browser_user_features(clean_events(read_sample_log(spark, MEDIUM), seconds=False, agent=False))
    names = [f"avg_userAgent_{i}_interactions" for i in range(5)]
    wide = {r["userId"]: [r[n] for n in names] for r in columns.collect()}
    vectors = {r["userId"]: r["labels"].toArray().tolist() for r in label_vectors.label_mean_vectors(clean_log, "userAgent").collect()}
    assert vectors.keys() == wide.keys()
    assert all(vectors[u] == pytest.approx(wide[u]) for u in wide)


def test_masked_correlation_equals_a_plain_one(spark):
    r = np.random.default_rng(3)
    frame = pd.DataFrame(r.standard_normal((400, 6)) + [0, 1e6, -5, 0, 3, 0], columns=list("abcdef"))
    frame["b"] += frame["a"]
    frame["f"] = 7.25
    frame.loc[frame["c"] < -5, "e"] = 2.0  # constant where c is small only
    holes = r.random((400, 6)) < 0.3
    frame = frame.mask(holes)
    rows = [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns)).repartition(4)
    found = explore.correlation_pairs(df, list(frame.columns))
    assert "Generate" not in plan(found)
    expected = frame.corr()
    for row in found.collect():
        value = expected.loc[row["feature_i"], row["feature_j"]]
        if "f" in (row["feature_i"], row["feature_j"]):
            assert row["correlation"] is None
        else:
            assert row["correlation"] == pytest.approx(value, abs=1e-9)


def test_correlation_of_odd_values(spark):
    rows = [(1.0, None, 1.0, 1e308), (2.0, None, float("nan"), 1.0), (4.0, 5.0, 3.0, 2.0), (None, 6.0, 4.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = {(r["feature_i"], r["feature_j"]): r["correlation"] for r in explore.correlation_pairs(df, ["a", "b", "c", "d"]).collect()}
    assert found["b", "a"] is None                     # one row in common
    assert np.isnan(found["c", "a"])                   # a NaN among the rows in common
    assert found["c", "b"] == pytest.approx(1)
    assert len(found) == 6
    assert {r["correlation"] for r in explore.correlation_pairs(df.limit(0), ["a", "b"]).collect()} <= {None}
