"""Where intermediate results go so that a lost executor costs no rerun."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_made: list[str] = []  # every path handed out, oldest first


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session that names none gets one in its warehouse, under the name
    of its application, removed when Python exits. On a cluster a missing
    setting is an error, since no folder can be guessed.
    """
    named = spark.conf.get(_SETTING, None)
    if named:
        return named
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = f"{warehouse}/_leavewatch-{context.applicationId}"
    context.setCheckpointDir(folder)
    atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete what was stored under paths of :func:`fresh_path`."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(settings).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns what is stored within it: all of that is deleted at the end.

    Results that still read such tables must be used inside.
    """
    before = len(_made)
    try:
        yield
    finally:
        remove(spark, _made[before:])
        del _made[before:]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once, keep the rows as a table in the shared folder, read that.

    For results that several passes need. A lost executor then costs a reread
    and not a rerun, later passes read only the columns they use, and the
    optimizer knows the real size. The table stays until the :func:`scratch`
    around it ends, or the folder is cleared.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
