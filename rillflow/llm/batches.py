"""Slices of Arrow batches, so that a task holds a bounded part of its texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa


def text_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``limit`` bytes with the index of their first row; NULL counts as empty.

    A longer text is a slice of its own.
    """
    start, own, size = 0, [], 0
    for k in range(len(column)):
        value = column[k]
        text = value.as_buffer().to_pybytes() if value.is_valid else b""
        if own and size + len(text) > limit:
            yield start, own
            start, own, size = k, [], 0
        own.append(text)
        size += len(text)
    if own:
        yield start, own
