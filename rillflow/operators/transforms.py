"""Record transforms: fields, locations, tokens, transport metadata, JSON records."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.functions.records import ALARM_SCHEMA, is_bad_record, object_count, parse_text, typed_record
from rillflow.functions.text import delimited_field, location_code, tokens


def with_once(df: DataFrame, alias: str, column: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row, however often it is used afterwards.

    Spark copies the expression of a projection into every filter and column above it, but not
    that of a generator.
    """
    return df.select("*", F.explode(F.array(column)).alias(alias))


def extract_field(
    df: DataFrame,
    index: int = 1,
    delimiter: str = ",",
    line: str = "value",
    alias: str = "field",
    on_short: str = "fail",
    header: str | None = None,
) -> DataFrame:
    """Add field ``index`` of a delimited line.

    Lines too short fail the job, or are dropped with ``on_short="skip"``. ``header`` names the
    exact text of a header line to leave out; by default a header counts as data.
    """
    if on_short not in ("fail", "skip"):
        raise ValueError("on_short must be 'fail' or 'skip'")
    rows = df if header is None else df.where(~F.col(line).eqNullSafe(header))
    if on_short == "fail":
        return rows.withColumn(alias, delimited_field(F.col(line), index, delimiter))
    return rows.withColumn(alias, delimited_field(F.col(line), index, delimiter, "null")).where(F.col(alias).isNotNull())


def with_location(df: DataFrame, line: str = "value", alias: str = "location", collapse: bool = True) -> DataFrame:
    """Add the location code of a tab-separated record."""
    return with_once(df, alias, location_code(F.col(line), collapse=collapse))


def tokenise(df: DataFrame, line: str = "value", alias: str = "word") -> DataFrame:
    """One row per non-empty space-separated word."""
    return df.select(F.explode(tokens(F.col(line))).alias(alias))


def strip_metadata(df: DataFrame, binary: bool = False) -> DataFrame:
    """Key and value of a log row, as text or (``binary``) as bytes; transport columns are dropped."""
    kind = "binary" if binary else "string"
    return df.select(F.col("key").cast(kind).alias("key"), F.col("value").cast(kind).alias("value"))


class ParsedRecords(NamedTuple):
    """Typed records, and the raw text of the rows that could not be parsed."""

    good: DataFrame
    bad: DataFrame


MALFORMED = "malformed"


def tag_records(df: DataFrame, value: str = "value", schema: T.StructType = ALARM_SCHEMA, required: Sequence[str] = ()) -> DataFrame:
    """Add ``record`` (NULL when bad), ``outcome`` (``good``/``bad``) and ``reason`` (NULL when good).

    A row is bad if its text is no record (``malformed``), or if the record lacks one of the ``required`` fields
    (``NULL in <field>``, the first of them). One pass for both outcomes: write with ``partitionBy("outcome")`` to keep the bad rows.
    """
    unknown = set(required) - set(schema.names)
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    parsed = F.col("_parsed")
    bad = is_bad_record(F.col(value), parsed, schema, F.col("_objects"))
    # A field of a well-formed record is NULL exactly if its text is: what does not fit its type is malformed.
    lacking = [F.when(parsed[name].isNull(), F.lit(f"NULL in {name}")) for name in required]
    reason = F.coalesce(F.when(bad, F.lit(MALFORMED)), *lacking)
    record = F.when(F.col("outcome") == "good", typed_record(parsed, schema))
    rows = with_once(df, "_both", F.struct(parse_text(F.col(value), schema).alias("_parsed"), object_count(F.col(value)).alias("_objects")))
    rows = rows.select("*", "_both.*").drop("_both").withColumn("reason", reason)
    rows = rows.withColumn("outcome", F.when(F.col("reason").isNull(), "good").otherwise("bad")).withColumn("record", record)
    return rows.drop("_parsed", "_objects")


def parse_records(
    df: DataFrame, value: str = "value", schema: T.StructType = ALARM_SCHEMA, on_bad: str = "quarantine"
) -> ParsedRecords | DataFrame:
    """Typed records of JSON text, as columns of ``schema``.

    ``on_bad``: ``quarantine`` returns good and bad rows (two passes if both are used; ``tag_records``
    serves both in one), ``drop`` leaves bad rows out, ``fail`` stops the job at the first one.
    """
    if on_bad not in ("quarantine", "drop", "fail"):
        raise ValueError("on_bad must be 'quarantine', 'drop' or 'fail'")
    tagged = tag_records(df, value, schema)
    if on_bad == "fail":
        message = F.concat(F.lit("bad record: "), F.coalesce(F.col(value), F.lit("null")))
        checked = F.when(F.col("outcome") == "good", F.col("record")).otherwise(F.raise_error(message))
        return with_once(tagged, "checked", checked).select("checked.*")
    good = tagged.where(F.col("outcome") == "good").select("record.*")
    if on_bad == "drop":
        return good
    return ParsedRecords(good, tagged.where(F.col("outcome") == "bad").select(value))


def require_non_null(df: DataFrame, *columns: str) -> DataFrame:
    """Fail the job on a NULL in any of the columns (all by default)."""
    for name in columns or df.columns:
        df = df.withColumn(name, F.coalesce(F.col(name), F.raise_error(F.lit(f"NULL in {name}"))))
    return df
