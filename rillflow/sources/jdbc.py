"""JDBC queries."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSplit:
    """A numeric, date or timestamp column by which a query is read in parallel.

    The bounds only place the cuts; rows outside them are read as well.
    """

    column: str
    lower: str | int
    upper: str | int
    partitions: int


def jdbc_options(
    url: str,
    query: str,
    driver: str | None = None,
    split: JdbcSplit | None = None,
    fetch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. Spark takes a bare query only for one connection; a split query is a subselect."""
    options = {"url": url, "fetchsize": str(fetch_rows), **(properties or {})}
    if driver:
        options["driver"] = driver
    if split is None:
        return {**options, "query": query}
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *columns: str,
    driver: str | None = None,
    split: JdbcSplit | None = None,
    fetch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """The result of a query, reduced to ``columns`` if given. Filters and columns reach the database.

    Give a ``split`` for large results: without one the whole result comes over one connection.
    """
    options = jdbc_options(url, query, driver, split, fetch_rows, properties)
    rows = spark.read.format("jdbc").options(**options).load()
    return rows.select(*columns) if columns else rows
