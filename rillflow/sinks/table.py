"""Batched, retried and replay-safe table output of a stream.

A micro-batch may be written more than once: after a retry here, or after a restart from the checkpoint.
Each write replaces what the same batch wrote before, so a replay changes nothing, while equal rows of
different batches are all kept. Batch numbers restart with a new checkpoint, so batches are kept apart by the
id of their query, which a checkpoint keeps over restarts.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]

BATCH_ID = "batch_id"
QUERY_ID = "query_id"
# Retries and first pause of the table sink.
MAX_RETRIES = 3
INITIAL_BACKOFF_SECONDS = 5.0


def with_retries(
    writer: BatchWriter,
    max_retries: int = MAX_RETRIES,
    initial_backoff: float = INITIAL_BACKOFF_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> BatchWriter:
    """Repeat a failed batch up to ``max_retries`` times, each pause twice the one before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(max_retries + 1):
            try:
                return writer(batch, batch_id)
            except Exception:
                if attempt == max_retries:
                    raise
                sleep(initial_backoff * 2**attempt)

    return write


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that a micro-batch belongs to, the same for all runs on one checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def file_batch_writer(path: str, fmt: str = "parquet", rows_per_file: int = 0) -> BatchWriter:
    """Write each batch to its own partition folder ``query_id=<id>/batch_id=<n>``, replacing that folder on a replay.

    Streams with different checkpoints add to each other. ``compact_batches`` merges the folders of old batches.

    ``rows_per_file`` caps the rows of one file; the tasks of a batch write side by side in any case.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").option("maxRecordsPerFile", str(rows_per_file)).save(
            f"{path}/{QUERY_ID}={query_id(batch)}/{BATCH_ID}={int(batch_id)}"
        )

    return write


def compact_batches(spark: SparkSession, path: str, target: str, fmt: str = "parquet", rows_per_file: int = 0) -> None:
    """Copy all finished batches into fewer files below ``target``, one folder per query.

    For streams that have written very many batches. Stop the stream first. Batches keep their numbers as a column.
    """
    rows = spark.read.format(fmt).load(path)
    rows.write.format(fmt).option("maxRecordsPerFile", str(rows_per_file)).partitionBy(QUERY_ID).save(target)


def jdbc_batch_writer(url: str, table: str, properties: Mapping[str, str] | None = None, block_rows: int = 1_000) -> BatchWriter:
    """Insert each batch in blocks of ``block_rows``, after deleting what the same batch left before.

    The table must exist and have a ``batch_id`` column, best indexed, and belongs to one checkpoint. Delete and
    insert are two transactions: a reader between them misses the batch. A task that is retried after its own
    commit, or runs twice, inserts its rows twice: let the table have a unique key, or turn speculation and task
    retries off for such a stream.
    """
    properties = dict(properties or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        _delete_batch(batch, url, table, properties, batch_id)
        (
            batch.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
            .write.format("jdbc")
            .options(url=url, dbtable=table, batchsize=str(block_rows), **properties)
            .mode("append")
            .save()
        )

    return write


def _delete_batch(batch: DataFrame, url: str, table: str, properties: Mapping[str, str], batch_id: int) -> None:
    jvm = batch.sparkSession.sparkContext._jvm
    settings = jvm.java.util.Properties()
    for name, value in properties.items():
        settings.setProperty(name, value)
    if "driver" in properties:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, settings)
    try:
        connection.createStatement().executeUpdate(f"delete from {table} where {BATCH_ID} = {int(batch_id)}")
    finally:
        connection.close()


def write_table_batches(
    stream: DataFrame,
    writer: BatchWriter,
    checkpoint: str,
    max_retries: int = MAX_RETRIES,
    initial_backoff: float = INITIAL_BACKOFF_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing a stream with a batch writer, retrying failed batches."""
    query = stream.writeStream.foreachBatch(with_retries(writer, max_retries, initial_backoff)).option(
        "checkpointLocation", checkpoint
    )
    return (query.trigger(availableNow=True) if available_now else query).start()
