"""Removing byte spans from the texts of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<start:long,end:long>>"


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Columns that tell rows apart unless they have the same id and text: equal rows get equal results."""
    return [F.col(id_col), F.md5(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))]


def merge(spans: np.ndarray) -> np.ndarray:
    """Union of ``(start, end)`` rows as sorted, disjoint, not touching spans."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    top = np.maximum.accumulate(spans[:, 1])
    heads = np.flatnonzero(np.concatenate(([True], spans[1:, 0] > top[:-1])))
    return np.column_stack((spans[heads, 0], top[np.append(heads[1:], len(spans)) - 1]))


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """What is left of a text without disjoint, sorted spans."""
    if not len(spans):
        return text
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _arrays(batches: Iterator[pa.RecordBatch], sort: bool) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[np.ndarray]]]:
    for batch in batches:
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        spans = []
        for value in batch.column(2):
            flat = value.values
            both = np.zeros((0, 2), np.int64) if flat is None or not len(flat) else np.column_stack([flat.field(k).to_numpy() for k in (0, 1)])
            spans.append(merge(both) if sort else both)
        yield batch, texts, spans


def remove_spans(rows: DataFrame) -> DataFrame:
    """``(id, n_bytes, removed, kept)`` for rows of ``(id, text, spans)``.

    ``spans`` are byte offsets into the UTF-8 text, in any order and overlapping; ``removed`` is their union.
    A NULL text is empty, and NULL spans are none. ``kept`` is BINARY: spans need not end between characters.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, spans in _arrays(batches, True):
            removed = pa.array([[{"start": a, "end": b} for a, b in s.tolist()] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            kept = pa.array([cut(t, s) for t, s in zip(texts, spans, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), removed, kept], names=["id", "n_bytes", "removed", "kept"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", F.col("text").cast("string"), "spans").mapInArrow(run, f"id {kind}, n_bytes long, removed {SPANS}, kept binary")


def removed_bytes(spans: str = "removed") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
