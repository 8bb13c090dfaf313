"""Text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    r"""One row (``value``) per line of text files on any file system Spark reaches.

    Lines end at ``\n``, ``\r\n`` or ``\r``. Large files are split between tasks; gzip and bzip2
    files are decompressed by extension, zip archives need ``read_zip_lines``.
    """
    return spark.read.text(paths if isinstance(paths, str) else list(paths))
