"""Session settings the package is tuned for."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Run-time re-planning: small partitions merged, skewed join partitions split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}

# Shuffle partitions of this size fit in a task's memory with room for sorting; scans use the same.
PARTITION_BYTES = 256 * 1024 * 1024


def size_settings(input_bytes: int) -> dict[str, str]:
    """Partition settings for jobs that read and shuffle about ``input_bytes``.

    The number of shuffle partitions is an upper one: run-time re-planning merges those that stay small.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(1, math.ceil(input_bytes / PARTITION_BYTES))),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
    }


def build_session(app_name: str = "rillflow", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; keyword names use ``__`` for dots. Leave ``master`` out on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    extra = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
