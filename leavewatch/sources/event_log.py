"""Scans and sinks of the event log and of the tables made from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from leavewatch.functions.numeric import stable_hash
from leavewatch.schema import EVENT_SCHEMA


def read_json_log(spark: SparkSession, path: str | list[str], infer: bool = False) -> DataFrame:
    """JSON lines as the event log; a path, a folder or a list of files.

    The fixed schema spares the full extra pass that inference costs, and
    keeps a column that happens to be all null.
    """
    reader = spark.read if infer else spark.read.schema(EVENT_SCHEMA)
    return reader.json(path)


def write_json_log(log: DataFrame, path: str) -> None:
    log.write.mode("errorifexists").json(path)


def copy_text_lines(spark: SparkSession, source: str, target: str) -> None:
    """Copy a text log line by line, whatever the lines hold."""
    spark.read.text(source).write.mode("errorifexists").text(target)


def changed_lines(spark: SparkSession, source: str, target: str) -> int:
    """How many distinct lines two text logs do not hold equally often.

    Number, sum and exclusive or of the lines' hashes are compared first, which
    needs no shuffle; only where they differ are the lines themselves counted.
    """
    sides = [spark.read.text(path) for path in (source, target)]
    told = [lines.agg(F.count(F.lit(1)), F.sum(F.xxhash64("value").cast("decimal(38,0)")),
                      F.bit_xor(F.xxhash64("value", F.lit(1)))).head() for lines in sides]
    if told[0] == told[1]:
        return 0
    both = sides[0].withColumn("side", F.lit(1)).unionByName(sides[1].withColumn("side", F.lit(-1)))
    return both.groupBy("value").agg(F.sum("side").alias("more")).where("more <> 0").count()


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def run_sql(df: DataFrame, query: str) -> DataFrame:
    """Run SQL text in the session the DataFrame belongs to."""
    return df.sparkSession.sql(query)


def with_hash_bucket(log: DataFrame, buckets: int = 10, key: str = "userId") -> DataFrame:
    """Add ``bucket``, equal for all rows of a user. No shuffle."""
    return log.withColumn("bucket", (stable_hash(F.col(key)) % buckets).cast("int"))


def write_user_buckets(bucketed: DataFrame, path: str, format: str = "json") -> None:
    """Write one folder per ``bucket``, so that a user lies in exactly one.

    The rebalance hint gives each folder few files, and lets adaptive
    execution split a folder that one user fills over many tasks.
    """
    (bucketed.hint("rebalance", F.col("bucket"))
     .write.mode("errorifexists").partitionBy("bucket").format(format).save(path))


def read_user_bucket(spark: SparkSession, path: str, bucket: int | None = None,
                     format: str = "json") -> DataFrame:
    """Read the split log; with a bucket given, only its folder is listed.

    A bucket without rows has no folder, and is an error.
    """
    schema = StructType(EVENT_SCHEMA.fields + [StructField("bucket", IntegerType())])
    reader = spark.read.schema(schema).format(format)
    if bucket is None:
        return reader.load(path)
    return reader.option("basePath", path).load(f"{path}/bucket={bucket}")


def write_features(features: DataFrame, path: str) -> None:
    """Publish the user table."""
    features.write.mode("errorifexists").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
