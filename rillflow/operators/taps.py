"""Row-count taps and the user-function hook."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tap(df: DataFrame, name: str = "tap", *metrics: Column) -> tuple[DataFrame, Observation | None]:
    """Measure a flow while it runs, without changing it or running it twice.

    The default metric is the row count ``n``; read it from the observation after an action. A stream has no
    observation: its metrics are in the progress of the query, per micro-batch, under ``name`` (``tapped``).
    """
    if df.isStreaming:
        return df.observe(name, *(metrics or (F.count(F.lit(1)).alias("n"),))), None
    observation = Observation(name)
    return df.observe(observation, *(metrics or (F.count(F.lit(1)).alias("n"),))), observation


def tapped(query: StreamingQuery, name: str = "tap", metric: str = "n") -> int:
    """Sum of a tapped metric over the micro-batches that the query still remembers."""
    observed = {p.batchId: p.observedMetrics.get(name) for p in query.recentProgress}
    return sum(row[metric] for row in observed.values() if row is not None)


def map_records(
    df: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]] | Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    arrow: bool = False,
) -> DataFrame:
    """Apply a user function to batches of rows; it may emit none, one or many rows per input row.

    Prefer column expressions: Spark cannot look inside ``fn``.
    """
    return df.mapInArrow(fn, schema) if arrow else df.mapInPandas(fn, schema)
