"""The user table as published: replaced whole, in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leavewatch.sources.manifest import Manifest


def publish_table(df: DataFrame, path: str) -> int:
    """Store the rows, then make them the table at the path; returns its version.

    Readers see the rows of before until the swap. A write that fails, at
    whatever point, changes nothing, and may be tried again.
    """
    manifest = Manifest(df.sparkSession, path)
    folder = manifest.fresh_folder("table")
    df.write.parquet(manifest.full(folder))
    return manifest.change(lambda state: {"table": folder, "schema": df.schema.json()})[0]


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as last published; an error if it never was."""
    manifest = Manifest(spark, path)
    found, state = manifest.read()
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(manifest.full(state["table"]))


def sweep_published(spark: SparkSession, path: str) -> list[str]:
    """Delete folders of older versions and of failed writes. Only where no one reads or writes."""
    manifest = Manifest(spark, path)
    _, state = manifest.read()
    return manifest.sweep({state["table"]} if state else set())
