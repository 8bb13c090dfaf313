"""Bag union and row caps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.workspace import land

# Spark numbers the rows of a partition in the lower bits of its row ids.
_PARTITION_SHIFT = 33


def flatten(*inputs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept. Columns are matched by name."""
    if not inputs:
        raise ValueError("flatten needs at least one input")
    return reduce(DataFrame.unionByName, inputs)


def take_any(df: DataFrame, n: int, stable: bool = False) -> DataFrame:
    """Any ``n`` rows: arbitrary, neither uniform nor repeatable.

    Each task passes on at most ``n`` rows and one task picks from them, so use it for small samples and
    ``cap_rows`` for large ones. The rows may differ at every use of the result, unless ``stable`` has them
    written below the scratch root (batch input only).
    """
    taken = df.limit(n)
    return land(taken, "sample") if stable and not df.isStreaming else taken


def cap_rows(df: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` rows, or all if there are fewer, without moving them to one task.

    Each task writes its first ``n`` rows below the scratch root; the counts per task, a row each, then say how
    many of them count. The result is stable. Batch input only: ``read_bounded`` caps streams in the same way.
    """
    if df.isStreaming:
        raise ValueError("cap a stream with read_bounded, or by the limits of its source")
    row = row_name(df)
    return within_quotas(land(first_of_each_task(df, n, row), "capped"), n, row).select(*df.columns)


def row_name(df: DataFrame) -> str:
    """A column name that ``df`` does not have."""
    name = "_row"
    while name in df.columns:
        name += "_"
    return name


def first_of_each_task(df: DataFrame, n: int, row: str) -> DataFrame:
    """The first ``n`` rows of every task with their number in the column ``row``. Land them before use: it may differ each time."""
    return df.withColumn(row, F.monotonically_increasing_id()).where(_place(row) < n)


def within_quotas(kept: DataFrame, n: int, row: str) -> DataFrame:
    """``n`` of the landed rows of ``first_of_each_task``, or all if there are fewer: whole tasks, then a part of one."""
    part = F.shiftright(row, _PARTITION_SHIFT)
    counts = kept.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per task that has any.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    quotas = counts.select(F.col("_part").alias("_task"), (F.lit(n) - F.coalesce(before, F.lit(0))).alias("_quota"))
    own = F.struct(*kept.columns).alias("_own")
    joined = kept.select(own, part.alias("_part"), _place(row).alias("_place")).join(F.broadcast(quotas), F.col("_part") == F.col("_task"))
    return joined.where("_place < _quota").select("_own.*")


def _place(row: str) -> Column:
    """The number of a row within its task."""
    return F.col(row).bitwiseAND(F.lit((1 << _PARTITION_SHIFT) - 1))
