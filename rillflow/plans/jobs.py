"""Complete jobs: each reads its input, applies a chain of operators and writes the result."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillflow.functions import co_group_line, count_document, count_json, group_line, key_value_text, location_code, to_record_json, to_utf8
from rillflow.functions.records import ALARM_SCHEMA
from rillflow.operators import (
    PAGE_SIZE,
    co_group,
    count_per_element,
    extract_field,
    flatten,
    group_by_key,
    parse_records,
    require_non_null,
    route,
    route_output,
    strip_metadata,
    tag_records,
    take_any,
    tokenise,
    where_valid_location,
    with_location,
)
from rillflow.sinks import copy_lines, log_rows, write_documents, write_lines, write_log, write_table_batches
from rillflow.sinks.documents import takes_rows
from rillflow.sinks.log import DEFAULT_KEY
from rillflow.sinks.table import BatchWriter
from rillflow.sources import dated_paths, read_dated_lines, read_lines
from rillflow.streaming import fan_out, read_bounded

# Fixed value: the location sent to its own queue.
QUEUE_LOCATION = "IN"


def write_prefix_outputs(words: DataFrame, target: str, prefixes: Sequence[str] = ("A", "B"), column: str = "word") -> None:
    """Words by prefix, each prefix into its own folder ``prefix=<p>``, in one pass over the input.

    Read them with ``read_tagged_lines``, which also knows the prefixes that no word has.
    """
    rules = [(p, F.col(column).startswith(p)) for p in prefixes]
    write_lines(route(words, rules, "prefix"), target, column, tag="prefix", tags=prefixes)


def write_main_route(words: DataFrame, target: str, rules: Sequence[tuple[str, Column]], column: str = "word") -> None:
    """Route the words and write the output of the first rule."""
    write_lines(route_output(route(words, rules), rules[0][0], rules=rules), target, column)


def write_union(inputs: Sequence[DataFrame], target: str, column: str = "word") -> None:
    """All rows of all inputs as lines."""
    write_lines(flatten(*inputs), target, column)


def co_group_lines(
    inputs: Mapping[str, tuple[DataFrame, str, str]], trailing_cr: bool = False, page_size: int = PAGE_SIZE
) -> DataFrame:
    """``key;[..];[..];`` lines of a co-group; a group of several pages gives one line per page, ending in ``page=<n>;``."""
    grouped = co_group(inputs, page_size)
    several = reduce(lambda a, b: a | b, [F.col("sizes")[name] > F.size(name) for name in inputs], F.col("page") > 0)
    line = co_group_line(F.col("key"), [F.col(name) for name in inputs])
    paged = F.when(several, F.concat(line, F.lit("page="), F.col("page").cast("string"), F.lit(";"))).otherwise(line)
    return grouped.select((F.concat(paged, F.lit("\r")) if trailing_cr else paged).alias("line"))


def group_lines(rows: DataFrame, key: str, value: str, page_size: int = PAGE_SIZE) -> DataFrame:
    """``key : [..]`` lines, for instance of a JDBC query; a group of several pages gives one line per page, ending in ``page=<n>``."""
    line = group_line(F.col(key), F.col("values"))
    several = (F.col("page") > 0) | (F.col("size") > F.size("values"))
    paged = F.when(several, F.concat(line, F.lit(" page="), F.col("page").cast("string"))).otherwise(line)
    return group_by_key(rows, key, value, page_size).select(paged.alias("line"))


def field_count_json(lines: DataFrame, index: int = 1, on_short: str = "fail", header: str | None = None) -> DataFrame:
    """Occurrences of a comma-separated field, as quoted JSON lines."""
    fields = extract_field(lines, index, on_short=on_short, header=header)
    return count_per_element(fields, "field").select(count_json(F.col("field"), F.col("n"), quoted=True).alias("json"))


def location_counts(lines: DataFrame, literal: bool = False, line: str = "value") -> DataFrame:
    """``(location, n)`` for the valid location codes of tab-separated records."""
    codes = with_location(lines, line).select("location")
    return count_per_element(where_valid_location(codes, literal=literal), "location")


def location_count_json(
    lines: DataFrame, sample: int | None = None, literal: bool = False, seen: Observation | None = None
) -> DataFrame:
    """Location counts as JSON lines, of all records or of any ``sample``.

    The observation ``seen`` gets the number ``n`` of records read.
    """
    read = lines if sample is None else take_any(lines, sample)
    if seen is not None:
        read = read.observe(seen, F.count(F.lit(1)).alias("n"))
    return location_counts(read, literal).select(count_json(F.col("location"), F.col("n")).alias("json"))


def write_dated_location_counts(
    spark: SparkSession,
    base: str,
    suffix: str,
    target: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    explicit: str | None = None,
    sample: int | None = None,
    literal: bool = False,
    seen: Observation | None = None,
) -> None:
    """Location counts of dated (optionally zipped) event files, written as JSON lines; ``seen`` counts the records."""
    lines = read_dated_lines(spark, base, suffix, start, end, explicit)
    write_lines(location_count_json(lines, sample, literal, seen), target, "json")


def key_value_log(records: DataFrame, fmt: str, options: Mapping[str, str], checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """``key # value`` of every log record into another log, values only."""
    rows = strip_metadata(records)
    return write_log(log_rows(rows, key_value_text(F.col("key"), F.col("value"))), fmt, options, checkpoint, available_now)


def outcome_writer(good: BatchWriter, bad: BatchWriter | None, value: str = "value", required: Sequence[str] = ()) -> BatchWriter:
    """Parse the alarm JSON of a batch once; typed records go to ``good``, raw bad rows to ``bad``.

    Without ``bad`` a bad row fails the batch. So does a NULL in a ``required`` column of a good one.
    """

    def write_good(tagged: DataFrame, batch_id: int) -> None:
        records = tagged.where(F.col("outcome") == "good").select("record.*")
        good(require_non_null(records, *required) if required else records, batch_id)

    def write_bad(tagged: DataFrame, batch_id: int) -> None:
        bad(tagged.where(F.col("outcome") == "bad").select(value), batch_id)

    if bad is None:

        def write_all(batch: DataFrame, batch_id: int) -> None:
            records = parse_records(batch, value, on_bad="fail")
            good(require_non_null(records, *required) if required else records, batch_id)

        return write_all
    both = fan_out([write_good, write_bad])
    return lambda batch, batch_id: both(tag_records(batch, value).select(value, "outcome", "record"), batch_id)


def alarm_table(
    records: DataFrame,
    good: BatchWriter,
    checkpoint: str,
    bad: BatchWriter | None = None,
    available_now: bool = False,
    required: Sequence[str] = (),
) -> StreamingQuery:
    """Typed alarm records of a log into a table, batch by batch. Bad rows go to ``bad``, or fail the query without it.

    A NULL in a ``required`` column fails the query as well.
    """
    return write_table_batches(strip_metadata(records), outcome_writer(good, bad, required=required), checkpoint, available_now=available_now)


def alarm_documents(
    records: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    checkpoint: str,
    available_now: bool = False,
    bad: BatchWriter | None = None,
) -> StreamingQuery:
    """Alarm records of a log, parsed and written again as documents: JSON text, or rows for a format that takes rows.

    Without ``bad`` a row that does not parse fails the query. With it such rows go there and the documents are
    written batch by batch, at least once.
    """

    def write(alarms: DataFrame) -> StreamingQuery | None:
        if takes_rows(fmt):
            return write_documents(alarms, fmt, options, None, checkpoint=checkpoint, available_now=available_now)
        docs = alarms.select(to_record_json(*ALARM_SCHEMA.names).alias("doc"))
        return write_documents(docs, fmt, options, checkpoint=checkpoint, available_now=available_now)

    if bad is None:
        return write(parse_records(strip_metadata(records), on_bad="fail"))
    both = outcome_writer(lambda alarms, _: write(alarms), bad)
    return write_table_batches(strip_metadata(records), both, checkpoint, available_now=available_now)


def file_words(spark: SparkSession, path: str) -> DataFrame:
    """Words of a text file."""
    return tokenise(read_lines(spark, path))


def send_bytes(
    values: DataFrame,
    fmt: str,
    options: Mapping[str, str],
    column: str = "value",
    key: Column | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery | None:
    """Values as UTF-8 bytes into a keyed log; without ``key`` all rows carry the default key."""
    rows = log_rows(values, to_utf8(F.col(column)), F.lit(DEFAULT_KEY) if key is None else key)
    return write_log(rows, fmt, options, checkpoint, available_now)


def receive_bytes(
    stream: DataFrame,
    start: tuple[str, object] | None = None,
    max_records: int | None = None,
    max_seconds: float | None = None,
    follow: bool = False,
) -> DataFrame:
    """Keyed byte records from a start time on: all present ones, or until a row or time limit is met."""
    return strip_metadata(read_bounded(stream, max_records, max_seconds, start, follow), binary=True)


def queue_to_lines_and_counts(
    payloads: DataFrame,
    lines_fmt: str,
    lines_options: Mapping[str, str],
    docs_fmt: str,
    docs_options: Mapping[str, str],
    code: str = QUEUE_LOCATION,
    max_records: int | None = None,
    follow: bool = False,
) -> None:
    """Two outputs of one queue: the raw lines of one location, and a count document per location.

    The queue is read once and landed, together with the location codes, before the two outputs.
    """
    coded = payloads.select(F.col("value").cast("string").alias("value"))
    coded = coded.withColumn("location", location_code(F.col("value")))
    landed = read_bounded(coded, max_records, follow=follow)
    write_log(log_rows(landed.where(F.col("location") == code), "value"), lines_fmt, lines_options)
    counts = count_per_element(where_valid_location(landed.select("location")), "location")
    if takes_rows(docs_fmt):
        write_documents(counts, docs_fmt, docs_options, None)
    else:
        write_documents(counts.select(count_document(F.col("location"), F.col("n")).alias("doc")), docs_fmt, docs_options)


def copy_dated_lines(
    spark: SparkSession,
    base: str,
    suffix: str,
    target: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    explicit: str | None = None,
) -> None:
    """Copy the lines of dated files to another place."""
    copy_lines(spark, dated_paths(base, suffix, start, end, explicit), target)
