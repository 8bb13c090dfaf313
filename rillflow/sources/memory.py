"""Literal rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_values(spark: SparkSession, rows: Iterable, schema: str | T.StructType) -> DataFrame:
    """A DataFrame of literal rows. Plain values are taken as one-column rows."""
    return spark.createDataFrame([row if isinstance(row, (tuple, list, dict)) else (row,) for row in rows], schema)
