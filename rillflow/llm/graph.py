"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.workspace import land, remove, scratch_path

# Rounds over few edges are written by few tasks: each has this many edges or more, unless there are not as many.
TASK_EDGES = 4096


def _with_lowest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the lowest ``v`` of its ``u``; the minimum is combined before its shuffle."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("low"))
    return edges.join(lowest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    stars = _with_lowest(both).where("v > u")
    return stars.select(F.col("v").alias("u"), F.least("u", "low").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    stars = _with_lowest(edges)
    moved = stars.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(stars.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (two LONG columns ``u`` and ``v``).

    The root is the lowest node of the component. Every round is a pair of grouped minimums and
    joins, written below the scratch root, so neither lineage nor driver memory grows; the folder of
    a round goes once the next one is written. A round has no more tasks at its end than its edges call for, so
    that small tables are not written as one file for each shuffle partition. Loops and repeated edges are
    ignored; no edges give no rows.
    """
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = land(ordered.distinct(), "edges", path)
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))
            ).distinct()
        seen, old, path = mark, path, scratch_path(spark, "edges")
        # No round has more edges than the one before.
        now = land(_small_star(_large_star(now).distinct()).coalesce(max(1, math.ceil(mark[0] / TASK_EDGES))), "edges", path)
        remove(spark, old)
