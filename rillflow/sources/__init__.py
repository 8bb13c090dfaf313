"""Readers."""

from rillflow.sources.archive import read_zip_lines
from rillflow.sources.dated import dated_paths, read_dated_lines
from rillflow.sources.jdbc import JdbcSplit, jdbc_options, read_jdbc
from rillflow.sources.log import read_file_log, read_log
from rillflow.sources.memory import from_values
from rillflow.sources.text import read_lines

__all__ = [
    "JdbcSplit",
    "dated_paths",
    "from_values",
    "jdbc_options",
    "read_dated_lines",
    "read_file_log",
    "read_jdbc",
    "read_lines",
    "read_log",
    "read_zip_lines",
]
