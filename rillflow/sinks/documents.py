"""Document stores: an index or a collection of JSON documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillflow.sinks.log import write_log


# Formats that carry one text per row; all others are taken to store rows with their columns.
TEXT_FORMATS = ("text", "kafka")


def takes_rows(fmt: str) -> bool:
    return fmt not in TEXT_FORMATS


def write_documents(
    df: DataFrame,
    fmt: str = "text",
    options: Mapping[str, str] | None = None,
    doc: str | None = "doc",
    id_col: str | None = None,
    checkpoint: str | None = None,
    available_now: bool = False,
) -> StreamingQuery | None:
    """Append documents to the store named in ``options``.

    ``fmt`` is a connector's format name, or ``text`` for files of JSON lines. With ``doc`` the documents are the
    JSON texts of that column. Without it every row is a document and its columns are the fields, as
    row-oriented connectors want it. Without ``id_col`` a repeated run appends the documents again; with it the
    connector can overwrite by id.
    """
    if doc is None:
        if not takes_rows(fmt):
            raise ValueError(f"{fmt} takes one text per row: name the column in doc")
        return write_log(df, fmt, options, checkpoint, available_now)
    columns = [doc] if id_col is None else [id_col, doc]
    return write_log(df.select(*columns), fmt, options, checkpoint, available_now)
