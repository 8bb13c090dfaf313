"""A bounded read of an unbounded source."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rillflow.operators.sets import first_of_each_task, row_name, within_quotas
from rillflow.workspace import remove, scratch_path

POLL_SECONDS = 0.2


def read_bounded(
    stream: DataFrame,
    max_records: int | None = None,
    max_seconds: float | None = None,
    start: tuple[str, object] | None = None,
    follow: bool = False,
    target: str | None = None,
) -> DataFrame:
    """Land a stream as a table and return that table.

    The read ends after ``max_records`` rows, after ``max_seconds``, or, unless ``follow`` is set, when
    everything present at the start has been read. ``start`` is a ``(column, value)`` pair: earlier
    rows are left out; a time without zone means what it says, in the zone of the column. The landed
    table can be read any number of times, the source only once; delete its folder (``target``) when done.

    With a row limit every task of a micro-batch lands the rows that might still count, up to the limit, and the counts
    of the tasks then say which do; no task sees more rows than its own. A batch that is cut off by the time limit or
    a failure while it is written leaves no rows in the result.
    """
    if follow and max_records is None and max_seconds is None:
        raise ValueError("following a stream needs max_records or max_seconds")
    spark = stream.sparkSession
    rows = stream if start is None else stream.where(F.col(start[0]) >= _bound(stream, *start))
    landing, checkpoint = target or scratch_path(spark, "landing"), scratch_path(spark, "landing-checkpoint")
    capped = None if max_records is None else CappedLanding(landing, max_records)
    if capped is None:
        writer = rows.writeStream.format("parquet").option("path", landing)
    else:
        writer = rows.writeStream.foreachBatch(capped.write)
    writer = writer.option("checkpointLocation", checkpoint)
    query = (writer if follow else writer.trigger(availableNow=True)).start()
    try:
        _wait(query, (lambda: False) if capped is None else (lambda: capped.left == 0), max_seconds)
    finally:
        remove(spark, checkpoint)  # the read is over; only the landed table is used on
    if capped is None:
        return spark.read.schema(stream.schema).parquet(landing)
    return capped.read(spark, stream.schema)


class CappedLanding:
    """Micro-batches landed in folders of their own until ``n`` rows are there; what comes later is left alone."""

    def __init__(self, path: str, n: int) -> None:
        self.path, self.left = path, n
        self.folders: list[str] = []

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Land a batch whole, or, if it has more rows than are left, as many of them."""
        if self.left == 0:
            return
        spark, row = batch.sparkSession, row_name(batch)
        folder = f"{self.path}/batch={batch_id}"
        first_of_each_task(batch, self.left, row).write.mode("overwrite").parquet(folder)
        schema = T.StructType([*batch.schema, T.StructField(row, T.LongType())])
        kept = spark.read.schema(schema).parquet(folder)
        n = kept.count()
        if n > self.left:
            cut = f"{self.path}/last"
            within_quotas(kept, self.left, row).write.mode("overwrite").parquet(cut)
            remove(spark, folder)
            folder, n = cut, self.left
        self.folders.append(folder)
        self.left -= n

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        if not self.folders:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*self.folders).select(*schema.names)


def _bound(stream: DataFrame, column: str, value: object) -> Column:
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        # As text, since Spark would take the value as a moment in the zone of this process.
        return F.lit(value.isoformat(sep=" ")).cast(stream.schema[column].dataType)
    return F.lit(value)


def _wait(query: StreamingQuery, full: Callable[[], bool], max_seconds: float | None) -> None:
    """Wait until the query ends, its landing is full, or the time is over, then stop it; a failure of the query is raised."""
    deadline = None if max_seconds is None else time.monotonic() + max_seconds
    try:
        while not query.awaitTermination(POLL_SECONDS):
            if full() or (deadline is not None and time.monotonic() >= deadline):
                break
    finally:
        if query.isActive:
            query.stop()
