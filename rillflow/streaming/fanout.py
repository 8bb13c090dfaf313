"""One input, several outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from rillflow.sinks.table import BatchWriter


def fan_out(writers: Sequence[BatchWriter]) -> BatchWriter:
    """A batch writer that feeds each micro-batch to all writers but reads it only once.

    Reading a queue twice would give each output other messages. The batch is kept in memory and on
    disk while it is written; lost blocks are read again from the offsets of the same batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for writer in writers:
                writer(kept, batch_id)
        finally:
            kept.unpersist()

    return write
