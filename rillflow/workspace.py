"""Shared scratch folders for landed streams, stream checkpoints and materialised tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must be able to reach.

    Only a local session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rillflow-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the scratch root."""
    return f"{scratch_root(spark)}/rillflow/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the scratch root and read it back: its lineage ends there."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator:
    """``with scratch(spark) as new: path = new("name")``: the folders go when the block ends.

    For work whose results are written before the block ends; a DataFrame that still reads one of
    the folders must not leave the block.
    """
    made: list[str] = []

    def new(name: str) -> str:
        made.append(scratch_path(spark, name))
        return made[-1]

    try:
        yield new
    finally:
        remove(spark, *made)


def clean(spark: SparkSession) -> None:
    """Delete all that this package has left below the scratch root: landed tables, checkpoints, lists of hot keys.

    Call it when no DataFrame of the package and no query is in use any more.
    """
    remove(spark, f"{scratch_root(spark)}/rillflow")
