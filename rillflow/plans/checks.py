"""Check queries: each runs one operator over whole tables and returns a result an oracle can recompute.

``rillflow.plans.oracles`` holds the SQL of the same names. Text, zip and log inputs are first written
by Spark from the tables, then read back through the operator.
"""

from __future__ import annotations

import datetime as dt
import threading
import zipfile
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import key_value_text, to_record_json, to_text, to_utf8
from rillflow.functions.records import ALARM_SCHEMA
from rillflow.operators import (
    cap_rows,
    co_group,
    count_per_element,
    extract_field,
    flatten,
    map_records,
    parse_records,
    route,
    route_output,
    strip_metadata,
    tag_records,
    take_any,
    tap,
    tokenise,
    where_prefix,
    where_valid_location,
    with_location,
)
from rillflow.plans import jobs
from rillflow.sinks import BatchTable, file_batch_writer, log_rows, read_tagged_lines, write_lines, write_log, write_table_batches
from rillflow.sources import from_values, read_dated_lines, read_file_log, read_lines, read_zip_lines
from rillflow.sources.archive import open_file_system
from rillflow.streaming import fan_out, read_bounded, run_to_end
from rillflow.workspace import land, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Page size of the check whose groups all have several pages.
SMALL_PAGE = 32
ZIP_MEMBER_BYTES = 64 * 1024 * 1024
# How long the read with a time limit goes on.
TIME_CAP_SECONDS = 6.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alarm_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarm records as a stream; every purchase is followed by text that is no record."""
    events = table_stream(spark, sf_dir, "events")
    good = alarm_json(events, "event_type").select("value", "event_type")
    value = F.when(F.col("event_type") == "purchase", F.concat("value", F.lit(" and more"))).otherwise(F.col("value"))
    return good.select(F.lit(None).cast("string").alias("key"), value.alias("value"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table read as a file stream. The pattern also fits a table that is a single file."""
    schema = table(spark, sf_dir, name).schema
    return read_file_log(spark, f"{sf_dir}/{name}.parque[t]", schema)


# Derived inputs


def order_lines(orders: DataFrame) -> DataFrame:
    """Tab-separated event records: order key, filler, location code, last field."""
    priority = F.col("o_orderpriority")
    code = (
        F.when(priority == "1-URGENT", "IN")
        .when(priority == "2-HIGH", "US")
        .when(priority == "3-MEDIUM", "-1")
        .when(priority == "4-NOT SPECIFIED", "IND")
        .when(F.col("o_orderstatus") == "F", "X")
        .otherwise("")
    )
    filler = F.repeat(F.lit("f\t"), 20)
    return orders.select(F.concat(F.col("o_orderkey").cast("string"), F.lit("\t"), filler, code, F.lit("\tz")).alias("value"))


def order_key(line: Column) -> Column:
    return F.get(F.split(line, "\t", 2), F.lit(0)).cast("bigint")


def alarm_json(events: DataFrame, *others: str) -> DataFrame:
    """Alarm records as JSON text, without a message for errors."""
    return events.select(
        *others,
        to_record_json(
            F.col("event_id").cast("string").alias("alarmid"),
            F.col("event_type").alias("alarmTitle"),
            F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("deviceModel"),
            (F.col("user_id") % 7).cast("int").alias("alarmSource"),
            F.when(F.col("event_type") != "error", F.col("props")).alias("alarmMsg"),
        ).alias("value")
    )


def mixed_json(events: DataFrame) -> DataFrame:
    """Alarm JSON in good and bad variants, one per event type."""
    kind = F.col("event_type")
    number = F.col("user_id").cast("string")
    value = (
        F.when((kind == "click") & (F.col("user_id") % 5 == 1), F.concat(F.lit('{"alarmSource":"'), number, F.lit('"}{"x":2}')))
        .when((kind == "click") & (F.col("user_id") % 5 == 2), F.concat(F.lit('{"alarmSource":"'), number, F.lit('"} junk}')))
        .when((kind == "click") & (F.col("user_id") % 5 == 3), F.concat(F.lit('{"alarmSource":"'), number, F.lit('"},{"x":2}')))
        .when(kind == "click", F.concat(F.lit('{"alarmSource":"'), number, F.lit('"}')))
        .when(kind == "view", F.concat(F.lit('{"alarmSource":'), number, F.lit(".0}")))
        .when(kind == "purchase", F.concat(F.lit('{"alarmSource":'), number, F.lit(".5}")))
        .when(kind == "signup", F.lit('{"ALARMID":"x"}'))
        .otherwise(F.concat(F.lit('{"alarmSource":'), number))
    )
    return events.select("event_type", value.alias("value"))


def log_records(events: DataFrame) -> DataFrame:
    """Keyed log rows; errors have no key."""
    return events.select(F.when(F.col("event_type") != "error", F.col("event_type")).alias("key"), F.col("props").alias("value"))


def written_text(spark: SparkSession, df: DataFrame, column: str) -> str:
    path = scratch_path(spark, "text")
    write_lines(df, path, column)
    return path


def written_zips(spark: SparkSession, df: DataFrame, column: str) -> str:
    """The texts of a column in zip archives, one archive per task, each with members of bounded size."""
    target = scratch_path(spark, "zip")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        files, folder = open_file_system(target)
        files.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():05d}"
        # Attempts write apart and the last step is a rename, so a repeated task leaves one archive.
        attempt = f"{folder}/{name}.{context.taskAttemptId()}.tmp"
        rows = 0
        with files.open_output_stream(attempt) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            member, left = None, 0
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    if member is None or left <= 0:
                        if member is not None:
                            member.close()
                        member, left = archive.open(f"{rows:012d}.txt", "w", force_zip64=True), ZIP_MEMBER_BYTES
                    data = (text or "").encode() + b"\n"
                    member.write(data)
                    left -= len(data)
                    rows += 1
            if member is not None:
                member.close()
        final = f"{folder}/{name}.zip"
        if files.get_file_info(final).type != pafs.FileType.NotFound:
            files.delete_file(final)
        files.move(attempt, final)
        yield pa.RecordBatch.from_pydict({"n": [rows]})

    df.select(column).mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()
    return target


def documents_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the document texts."""
    return table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("value"))


def landed(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its present end twice on one checkpoint, as after a restart; return what it wrote."""
    target, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    for _ in range(2):
        run_to_end(write_log(stream, "parquet", {"path": target}, checkpoint, available_now=True))
    return spark.read.schema(stream.schema).parquet(target)


# Sources


def src_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = from_values(spark, ["apple", "quince", "1-URGENT"], "word string")
    priorities = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("word"))
    return count_per_element(flatten(words, priorities), "word")


def src_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_text(spark, table(spark, sf_dir, "documents"), "text")
    return count_per_element(read_lines(spark, path), "value")


def src_zip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_zips(spark, table(spark, sf_dir, "documents"), "text")
    return count_per_element(read_zip_lines(spark, path), "value")


def src_zip_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zipped event records to JSON location counts."""
    path = written_zips(spark, order_lines(table(spark, sf_dir, "orders")), "value")
    return jobs.location_count_json(read_zip_lines(spark, path), sample=None)


def src_dated_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    base = scratch_path(spark, "dated")
    day = F.date_format("ts", "yyyyMMdd")
    write_lines(events.select(F.concat_ws(",", day, "event_type").alias("value"), day.alias("day")), base, tag="day")
    # The range is wider than the days there are.
    around = {"start": first.date() - dt.timedelta(days=3), "end": last.date() + dt.timedelta(days=3)}
    lines = read_dated_lines(spark, f"{base}/day=", missing="skip", **around)
    return count_per_element(lines.select(F.split("value", ",")[0].alias("day")), "day")


def stream_log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table_stream(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("key"), to_utf8(F.col("event_type")).alias("value"), "ts"
    )
    rows = landed(spark, strip_metadata(records), "log")
    return rows.select(F.col("key").cast("bigint").alias("event_id"), F.col("value").alias("event_type"))


def stream_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = ("ts", dt.datetime(2024, 1, 10))
    rows = read_bounded(table_stream(spark, sf_dir, "events").select("event_id", "ts"), start=start)
    return rows.orderBy("ts", "event_id").limit(10).select("event_id")


def queue_bounded_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read capped at half of the source: how many rows, how many different ones, and how many of them are in it."""
    half = table(spark, sf_dir, "events").count() // 2
    return _sample_report(spark, sf_dir, read_bounded(table_stream(spark, sf_dir, "events"), max_records=half))


def _sample_report(spark: SparkSession, sf_dir: str, sample: DataFrame) -> DataFrame:
    known = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", F.lit(1).alias("known"))
    rows = sample.select("event_id", "ts", "user_id").join(known, ["event_id", "ts", "user_id"], "left")
    counts = [F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("n_distinct"), F.count("known").alias("n_known")]
    return rows.agg(*counts)


def job_dated_location_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a folder that holds both zip archives and plain files, counted by the whole job."""
    orders = table(spark, sf_dir, "orders")
    source, target = written_zips(spark, order_lines(orders.where("o_orderstatus = 'F'")), "value"), scratch_path(spark, "dated-counts")
    write_lines(order_lines(orders.where("o_orderstatus <> 'F'")), source, mode="append")
    jobs.write_dated_location_counts(spark, "", "", target, explicit=source)
    return read_lines(spark, target).withColumnRenamed("value", "json")


def job_receive_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keyed bytes that were sent, received by the job."""
    target = scratch_path(spark, "bytes-log")
    jobs.send_bytes(table(spark, sf_dir, "events"), "parquet", {"path": target}, "event_id")
    rows = jobs.receive_bytes(read_file_log(spark, target, "key string, value binary"))
    return rows.select(to_text(F.col("key")).alias("key"), to_text(F.col("value")).alias("payload"))


def job_file_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = written_text(spark, table(spark, sf_dir, "conversations"), "text")
    return count_per_element(jobs.file_words(spark, path), "word")


def job_main_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "main-route")
    jobs.write_main_route(table(spark, sf_dir, "part"), target, _rules(), "p_name")
    return count_per_element(read_lines(spark, target), "value")


def job_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "union")
    names = [table(spark, sf_dir, t).select(F.col(c).alias("value")) for t, c in (("customer", "c_name"), ("supplier", "s_name"))]
    jobs.write_union(names, target, "value")
    return read_lines(spark, target)


# Sinks


def snk_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name").alias("value"))
    return read_lines(spark, written_text(spark, lines, "value"))


def snk_text_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = written_text(spark, table(spark, sf_dir, "conversations"), "text")
    target = scratch_path(spark, "copy")
    jobs.copy_dated_lines(spark, "", "", target, explicit=source)
    return count_per_element(read_lines(spark, target), "value")


def snk_keyed_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "bytes")
    jobs.send_bytes(table(spark, sf_dir, "events"), "parquet", {"path": target}, "event_id")
    rows = spark.read.schema("key string, value binary").parquet(target)
    return rows.select("key", to_text(F.col("value")).alias("payload"))


def snk_routed_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix outputs written in one pass, then read back one by one; no part has the last prefix."""
    target, prefixes = scratch_path(spark, "routed"), ("s", "r", "#")
    jobs.write_prefix_outputs(table(spark, sf_dir, "part"), target, prefixes, "p_name")
    outputs = [read_tagged_lines(spark, target, "prefix", p).withColumn("output", F.lit(p)) for p in prefixes]
    return count_per_element(flatten(*outputs), "output", "value")


def sink_idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own write one target, every batch twice; all rows of both stay once."""
    target = scratch_path(spark, "replay")
    write = file_batch_writer(target)

    def write_twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    stream = table_stream(spark, sf_dir, "events").select("event_id", "event_type")
    checkpoints = [scratch_path(spark, "replay-checkpoint") for _ in range(2)]
    for checkpoint in [*checkpoints, *checkpoints]:
        run_to_end(write_table_batches(stream, write_twice, checkpoint, available_now=True))
    return spark.read.parquet(target).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def sink_compacted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint, every batch written twice; the table is compacted after each, and has all rows once."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    folder, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "compacted-checkpoint")
    target = BatchTable(spark, scratch_path(spark, "compacted"))

    def write_twice(batch: DataFrame, batch_id: int) -> None:
        target.write(batch, batch_id)
        target.write(batch, batch_id)

    for half in range(2):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == half).write.mode("append").parquet(folder)
        stream = read_file_log(spark, folder, events.schema, files_per_batch=2)
        run_to_end(write_table_batches(stream, write_twice, checkpoint, available_now=True))
        target.compact(small_rows=events.count())
    return target.read().groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_failure_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A writer fails after half of a batch, which ends the query; started again on its checkpoint it writes all rows once."""
    target, checkpoint = scratch_path(spark, "failed"), scratch_path(spark, "failed-checkpoint")
    stream, write = table_stream(spark, sf_dir, "events").select("event_id", "event_type"), file_batch_writer(target)

    def fail(batch: DataFrame, batch_id: int) -> None:
        write(batch.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0), batch_id)
        raise ConnectionError("half of the batch is written")

    query = write_table_batches(stream, fail, checkpoint, max_retries=0, available_now=True)
    try:
        run_to_end(query)
    except StreamingQueryException:
        pass
    if query.isActive or query.exception() is None:
        raise AssertionError("the query must end with the failure of its writer")
    run_to_end(write_table_batches(stream, write, checkpoint, available_now=True))
    return spark.read.parquet(target).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_time_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read that follows files arriving in two steps until its time is over, held against the files it landed.

    All that was there at the start or nothing is landed, files are landed whole, and no row twice.
    """
    events, folder = table(spark, sf_dir, "events").select("event_id", "ts", "user_id"), scratch_path(spark, "steps")

    def arrive(step: int) -> None:
        part = events.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == step)
        part.withColumn("step", F.lit(step)).write.mode("append").parquet(folder)

    arrive(0)
    stream = read_file_log(spark, folder, spark.read.parquet(folder).schema).select("*", F.col("_metadata.file_name").alias("file"))
    later = threading.Timer(2.0, arrive, [1])
    later.start()
    landed = read_bounded(stream, max_seconds=TIME_CAP_SECONDS, follow=True)
    later.join()
    source = spark.read.parquet(folder).select("step", F.col("_metadata.file_name").alias("file"))
    by_file = source.groupBy("file", "step").agg(F.count(F.lit(1)).alias("rows"))
    seen = landed.groupBy(F.col("file").alias("landed_file")).agg(F.count(F.lit(1)).alias("landed_rows"))
    both = by_file.join(seen, F.col("file") == F.col("landed_file"), "full")
    whole = F.coalesce(F.bool_and(F.coalesce(F.col("landed_rows") == F.col("rows"), F.col("landed_rows").isNull())), F.lit(True))
    first = F.count_if((F.col("step") == 0) & F.col("landed_rows").isNotNull())
    all_or_none = (first == 0) | (first == F.count_if(F.col("step") == 0))
    repeated = landed.agg(F.count(F.lit(1)) - F.countDistinct("event_id", "ts", "user_id")).first()[0]
    flags = [whole.alias("whole_files"), all_or_none.alias("whole_first_step")]
    return both.agg(*flags, F.lit(repeated).cast("bigint").alias("n_repeated"), F.sum("rows").alias("n_source"))


def stream_batched_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows as records, bad ones by their text, each once although the stream ran twice."""
    target, bad, checkpoint = (scratch_path(spark, name) for name in ("table", "table-bad", "table-checkpoint"))
    for _ in range(2):
        run_to_end(jobs.alarm_table(alarm_log(spark, sf_dir), file_batch_writer(target), checkpoint, file_batch_writer(bad), available_now=True))
    good = spark.read.parquet(target).select("alarmid", "alarmSource", F.lit(None).cast("string").alias("bad_text"))
    return good.unionByName(spark.read.parquet(bad).select(F.col("value").alias("bad_text")), allowMissingColumns=True)


def stream_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of good rows, and the texts of bad ones."""
    target, bad, checkpoint = (scratch_path(spark, name) for name in ("documents", "documents-bad", "documents-checkpoint"))
    for _ in range(2):
        run_to_end(jobs.alarm_documents(alarm_log(spark, sf_dir), "text", {"path": target}, checkpoint, available_now=True, bad=file_batch_writer(bad)))
    good = read_lines(spark, target).select(F.col("value").alias("doc"), F.lit("good").alias("outcome"))
    return good.union(spark.read.parquet(bad).select("value", F.lit("bad")))


def stream_kv_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, checkpoint = scratch_path(spark, "concat"), scratch_path(spark, "concat-checkpoint")
    records = log_records(table_stream(spark, sf_dir, "events"))
    for _ in range(2):
        run_to_end(jobs.key_value_log(records, "text", {"path": target}, checkpoint, available_now=True))
    return read_lines(spark, target).withColumnRenamed("value", "line")


def fanout_country_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous fan-out: each micro-batch is read once and written to both outputs."""
    lines_path, counts_path = scratch_path(spark, "fanout-lines"), scratch_path(spark, "fanout-counts")
    write_raw, write_counts = file_batch_writer(lines_path), file_batch_writer(counts_path)
    both = fan_out(
        [
            lambda batch, batch_id: write_raw(log_rows(batch.where(F.col("location") == "IN"), "value"), batch_id),
            lambda batch, batch_id: write_counts(count_per_element(where_valid_location(batch.select("location")), "location"), batch_id),
        ]
    )
    lines = with_location(order_lines(table_stream(spark, sf_dir, "orders")))
    run_to_end(write_table_batches(lines, both, scratch_path(spark, "fanout-checkpoint"), available_now=True))
    return spark.read.schema("value string").parquet(lines_path).select(order_key(F.col("value")).alias("o_orderkey"))


def doc_count_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines_path, docs_path = scratch_path(spark, "queue-lines"), scratch_path(spark, "queue-documents")
    jobs.queue_to_lines_and_counts(
        order_lines(table_stream(spark, sf_dir, "orders")),
        "parquet",
        {"path": lines_path},
        "text",
        {"path": docs_path},
        max_records=None,
    )
    return read_lines(spark, docs_path).withColumnRenamed("value", "doc")


# Record transforms


def prj_bytes_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "events").select("event_id", to_utf8(F.col("event_id")).alias("data"))
    return records.select("event_id", to_text(F.col("data")).alias("payload"))


def prj_tokenise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_element(tokenise(documents_lines(spark, sf_dir)), "word")


def prj_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(
        F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand", "p_type").alias("value"), "p_partkey"
    )
    return extract_field(lines, 1, alias="label").select("p_partkey", "label")


def prj_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_location(order_lines(table(spark, sf_dir, "orders")))
    return lines.select(order_key(F.col("value")).alias("o_orderkey"), F.col("location").alias("country"))


def prj_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(alarm_json(table(spark, sf_dir, "events")), on_bad="fail")


def prj_json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad rows are written in one pass and counted per input kind and reason; a record must have its source."""
    path = scratch_path(spark, "outcomes")
    tag_records(mixed_json(table(spark, sf_dir, "events")), required=("alarmSource",)).write.partitionBy("outcome").parquet(path)
    rows = spark.read.parquet(path)
    source = F.coalesce(F.sum(F.col("record.alarmSource").cast("bigint")), F.lit(0)).cast("bigint").alias("sum_source")
    return rows.groupBy("outcome", F.coalesce("reason", F.lit("")).alias("reason"), "event_type").agg(F.count(F.lit(1)).alias("n"), source)


def prj_json_serialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    alarms = parse_records(alarm_json(table(spark, sf_dir, "events")), on_bad="drop")
    return alarms.select(to_record_json(*ALARM_SCHEMA.names).alias("doc"))


def prj_key_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_records(table(spark, sf_dir, "events"))
    return count_per_element(rows.select(key_value_text(F.col("key"), F.col("value")).alias("line")), "line")


def prj_observe_tap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tap on a flow that is written elsewhere; the tapped count comes back as a row."""
    tapped, seen = tap(table(spark, sf_dir, "events"))
    tapped.write.format("noop").mode("overwrite").save()
    return from_values(spark, [int(seen.get["n"])], "n bigint")


def udf_map_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    def double_clicks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clicks = batch[batch["event_type"] == "click"]
            yield pd.DataFrame({"event_id": clicks["event_id"], "value2": clicks["value"] * 2})

    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return map_records(events, double_clicks, "event_id bigint, value2 double")


# Filters and routing


def flt_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_prefix(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "s")


def _rules() -> list[tuple[str, Column]]:
    name = F.col("p_name")
    return [("A", name.startswith("s")), ("B", name.startswith("r"))]


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route(table(spark, sf_dir, "part").select("p_partkey", "p_name"), _rules())


def flt_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("p_partkey", "tag")


def flt_route_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_output(_routed(spark, sf_dir), "A", rules=_rules()).select("p_partkey")


# Counting, grouping, co-grouping


def agg_count_per_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_per_element(table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("element")), "element")


def agg_count_by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.location_counts(order_lines(table(spark, sf_dir, "orders"))).withColumnRenamed("location", "country")


def agg_count_by_location_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(table(spark, sf_dir, "orders"))
    return jobs.location_counts(lines, literal=True).withColumnRenamed("location", "country")


def agg_count_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.location_count_json(order_lines(table(spark, sf_dir, "orders")), sample=None)


def agg_count_json_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "part").select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_brand").alias("value"))
    return jobs.field_count_json(lines)


def agg_group_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("o_orderkey"))
    return jobs.group_lines(rows, "o_custkey", "o_orderkey")


def _digest_number(value: Column) -> Column:
    """60 bits of the MD5 of a text as a number."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _digests(name: str, own: Column, number: Column) -> list[Column]:
    """Count, and a digest that does not depend on order, of the rows that are ``own``; all of it combines before a shuffle."""
    mine = F.when(own, number)
    total = F.coalesce(F.sum(mine.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").cast("string")
    ends = [F.coalesce(end(mine), F.lit(0).cast("bigint")).alias(f"{end.__name__}_{name}") for end in (F.min, F.max)]
    return [F.count_if(own).alias(f"n_{name}"), *ends, total.alias(f"sum_{name}")]


def _grouped_digests(grouped: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per key of paged groups: digests of the values on all pages, and whether every page gives their numbers.

    No group is put together again: the values of a page are rows of their own, which combine by key.
    """
    values = [F.expr(f"transform({name}, v -> struct({i} as tag, cast(v as string) as text))") for i, name in enumerate(names)]
    listed = grouped.select(F.col("key").alias("k"), "page", "sizes", F.explode_outer(F.concat(*values)).alias("v"))
    number = _digest_number(F.col("v.text"))
    each = [column for i, name in enumerate(names) for column in _digests(name, F.col("v.tag") == i, number)]
    sizes = [F.max(f"sizes.{name}").alias(f"size_{name}") for name in names] + [F.min(f"sizes.{name}").alias(f"least_{name}") for name in names]
    told = [(F.col(f"size_{n}") == F.col(f"n_{n}")) & (F.col(f"least_{n}") == F.col(f"n_{n}")) for n in names]
    summed = listed.groupBy("k").agg(*each, *sizes)
    return summed.withColumn("same_sizes", reduce(Column.__and__, told)).drop(*(f"{kind}_{n}" for n in names for kind in ("size", "least")))


def agg_group_by_key_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names per brand: few keys and few values, so that every group has several pages.

    A row for every name on every page, copies kept, and beside it the number and a digest of the names of its group.
    No group is put together again.
    """
    lines = jobs.group_lines(table(spark, sf_dir, "part"), "p_brand", "p_name", SMALL_PAGE)
    parts = [F.regexp_extract("line", r"^(.*?) : \[(.*)\](?: page=\d+)?$", i).alias(c) for i, c in ((1, "k"), (2, "text"))]
    names = land(lines.select(*parts).select("k", F.posexplode(F.split("text", ", ")).alias("at", "name")), "names")
    digests = _digests("names", F.lit(True), _digest_number(F.col("name")))
    few = (F.count_if(F.col("at") == 0) <= F.ceil(F.count(F.lit(1)) / SMALL_PAGE)).alias("few_pages")
    groups = names.groupBy("k").agg(*digests, few)
    return names.select("k", "name").join(groups, "k")


def join_cogroup_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers per nation, and all orders under one key of their own, on several pages."""
    customers, suppliers, orders = (table(spark, sf_dir, name) for name in ("customer", "supplier", "orders"))
    one_key = orders.select(F.lit(-1).alias("o_nation"), "o_orderpriority")
    inputs = {"customers": (customers, "c_nationkey", "c_name"), "suppliers": (suppliers, "s_nationkey", "s_name"), "orders": (one_key, "o_nation", "o_orderpriority")}
    return _grouped_digests(co_group(inputs, SMALL_PAGE), list(inputs))


def join_cogroup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers per nation, one line per page."""
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return jobs.co_group_lines(
        {"customers": (customers, "c_nationkey", "c_name"), "suppliers": (suppliers, "s_nationkey", "s_name")}
    )


def join_cogroup3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, orders and events per customer key, as digests of the lists."""
    customers, orders, events = (table(spark, sf_dir, name) for name in ("customer", "orders", "events"))
    grouped = co_group(
        {
            "customers": (customers, "c_custkey", "c_name"),
            "orders": (orders, "o_custkey", "o_orderkey"),
            "events": (events, "user_id", "event_type"),
        }
    )
    return _grouped_digests(grouped, ("customers", "orders", "events"))


# Union and caps


def set_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))
    return flatten(customers, suppliers)


def lim_sample_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample_report(spark, sf_dir, take_any(table(spark, sf_dir, "events"), 10, stable=True))


def lim_cap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large cap: half of all rows, without a task that sees them all."""
    events = table(spark, sf_dir, "events")
    return _sample_report(spark, sf_dir, cap_rows(events, events.count() // 2))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        src_values,
        src_text_lines,
        src_zip_lines,
        src_zip_locations,
        src_dated_paths,
        stream_log_source,
        stream_bounded_read,
        queue_bounded_read,
        snk_text_roundtrip,
        snk_text_copy,
        snk_keyed_bytes,
        snk_routed_outputs,
        sink_idempotent_replay,
        sink_compacted_batches,
        stream_failure_restart,
        stream_time_cap,
        stream_batched_sink,
        stream_json_documents,
        stream_kv_concat,
        fanout_country_equals,
        doc_count_by_location,
        prj_bytes_payload,
        prj_tokenise,
        prj_field,
        prj_location,
        prj_json_parse,
        prj_json_quarantine,
        prj_json_serialise,
        prj_key_value,
        prj_observe_tap,
        udf_map_records,
        flt_prefix,
        flt_route,
        flt_route_main,
        agg_count_per_element,
        agg_count_by_location,
        agg_count_by_location_literal,
        agg_count_json,
        agg_count_json_quoted,
        agg_group_by_key,
        agg_group_by_key_paged,
        join_cogroup,
        join_cogroup3,
        join_cogroup_paged,
        job_dated_location_counts,
        job_receive_bytes,
        job_file_words,
        job_main_route,
        job_union,
        lim_cap_rows,
        set_flatten,
        lim_sample_any,
    )
}
