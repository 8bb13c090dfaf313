"""Filters and routing. All predicates are native, so they reach the scan where the source allows it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.text import location_code, valid_location


def where_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose text starts with ``prefix`` (case-sensitive); pushed down to Parquet."""
    return df.where(F.col(column).startswith(prefix))


def where_valid_location(df: DataFrame, column: str = "location", literal: bool = False) -> DataFrame:
    """Rows with a valid two-character location code."""
    return df.where(valid_location(F.col(column), literal))


def where_location(df: DataFrame, code: str, line: str = "value") -> DataFrame:
    """Unchanged records whose location code equals ``code``."""
    return df.where(location_code(F.col(line)) == code)


def route(df: DataFrame, rules: Sequence[tuple[str, Column]], tag: str = "tag") -> DataFrame:
    """Tag each row with the first rule it meets and drop rows that meet none.

    One pass serves all outputs: write with ``partitionBy(tag)``, or take one with ``route_output``. Rows that
    meet no rule are left out by a plain condition first, which sources can take over.
    """
    if not rules:
        raise ValueError("route needs at least one rule")
    (name, met), *others = rules
    chosen = F.when(met, F.lit(name))
    for name, met in others:
        chosen = chosen.when(met, F.lit(name))
    return df.where(reduce(lambda a, b: a | b, (met for _, met in rules))).withColumn(tag, chosen).where(F.col(tag).isNotNull())


def route_output(routed: DataFrame, name: str, tag: str = "tag", rules: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """The rows of one output of ``route``, without the tag.

    With the ``rules`` of ``route`` the conditions of this output reach the source as well.
    """
    own = [met for rule, met in rules if rule == name]
    if own:
        routed = routed.where(reduce(lambda a, b: a | b, own))
    return routed.where(F.col(tag) == name).drop(tag)
