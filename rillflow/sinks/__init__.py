"""Writers."""

from rillflow.sinks.batch_table import BatchTable
from rillflow.sinks.documents import write_documents
from rillflow.sinks.log import log_rows, write_log
from rillflow.sinks.table import compact_batches, file_batch_writer, jdbc_batch_writer, with_retries, write_table_batches
from rillflow.sinks.text import copy_lines, read_tagged_lines, write_lines

__all__ = [
    "BatchTable",
    "compact_batches",
    "copy_lines",
    "file_batch_writer",
    "jdbc_batch_writer",
    "log_rows",
    "read_tagged_lines",
    "with_retries",
    "write_documents",
    "write_lines",
    "write_log",
    "write_table_batches",
]
