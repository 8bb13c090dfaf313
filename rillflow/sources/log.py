"""Message logs and queues, as streams."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_log(
    spark: SparkSession,
    options: Mapping[str, str],
    fmt: str = "kafka",
    start: str | dt.datetime = "earliest",
) -> DataFrame:
    """An unbounded log read from ``start``: ``earliest``, ``latest`` or a timezone-aware time.

    The start counts for the first run only; later runs go on from the checkpoint. Limit a
    micro-batch with the connector's own option, such as ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if isinstance(start, dt.datetime):
        if start.tzinfo is None:
            raise ValueError("a start time needs a time zone")
        return reader.option("startingTimestamp", str(int(start.timestamp() * 1000))).load()
    return reader.option("startingOffsets", start).load()


def read_file_log(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    fmt: str = "parquet",
    files_per_batch: int = 1_000,
) -> DataFrame:
    """Files that arrive below ``path``, each read once, at most ``files_per_batch`` per micro-batch."""
    return spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", str(files_per_batch)).load(path)
