"""Message log and queue output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed value: the key of keyed byte records when none is given.
DEFAULT_KEY = "pkey"


def log_rows(df: DataFrame, value: Column | str, key: Column | str | None = None) -> DataFrame:
    """Rows of a log: ``value`` alone, or ``key`` and ``value``.

    The key chooses the log partition. A constant one (``lit(DEFAULT_KEY)``) sends everything to the
    same partition; use a column to spread the load.
    """
    column = F.col(value) if isinstance(value, str) else value
    if key is None:
        return df.select(column.alias("value"))
    return df.select((F.col(key) if isinstance(key, str) else key).alias("key"), column.alias("value"))


def write_log(
    rows: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery | None:
    """Append log rows to a topic or folder named in ``options`` (``topic``, ``path``).

    A stream needs a ``checkpoint`` and returns its query. Delivery is at least once with a log
    connector and exactly once with files.
    """
    options = dict(options or {})
    if not rows.isStreaming:
        rows.write.format(fmt).options(**options).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = rows.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
