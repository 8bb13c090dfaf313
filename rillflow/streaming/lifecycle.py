"""Waiting for a query."""

from __future__ import annotations

from pyspark.sql.streaming import StreamingQuery


def run_to_end(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait until the query ends, or for ``timeout`` seconds; a query still running is stopped.

    A failure of the query is raised. Returns whether it ended by itself.
    """
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    finally:
        if query.isActive:
            query.stop()
