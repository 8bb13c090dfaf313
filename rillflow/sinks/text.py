"""Text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.sources.text import read_lines


# The list of known tags, in a folder that readers of the lines pass over.
TAGS = "_tags"


def write_lines(
    df: DataFrame, path: str, line: str = "value", tag: str | None = None, mode: str = "overwrite", tags: Sequence[str] | None = None
) -> None:
    """One line per row into text files below ``path``, one file per task.

    With ``tag`` the rows go to one folder per value of that column, all in the same job. They are brought together
    by tag first, each tag over a number of tasks that run-time re-planning chooses by its size, so that there are
    not as many files as tasks times tags.

    ``tags`` names all tags there may be: a row with another one, or none, fails the job, and the list is kept with the output,
    so that ``read_tagged_lines`` knows a tag without rows from one that does not exist.
    """
    if tag is None:
        if tags is not None:
            raise ValueError("tags need the column they stand in")
        df.select(line).write.mode(mode).text(path)
        return
    rows = df.select(line, tag)
    if tags is not None:
        other = F.raise_error(F.concat(F.lit("no known tag: "), F.coalesce(F.col(tag).cast("string"), F.lit("NULL"))))
        rows = rows.withColumn(tag, F.when(F.col(tag).isin(list(tags)), F.col(tag)).otherwise(other))
    rows.hint("rebalance", tag).write.mode(mode).partitionBy(tag).text(path)
    if tags is not None:
        known = df.sparkSession.createDataFrame([(str(name),) for name in tags], "tag string")
        known.coalesce(1).write.mode("overwrite").json(f"{path}/{TAGS}")


def read_tagged_lines(spark: SparkSession, path: str, tag: str, value: str) -> DataFrame:
    """The lines (``value``) of one tag of an output written with its ``tags``; none if no row had that tag."""
    known = {row.tag for row in spark.read.schema("tag string").json(f"{path}/{TAGS}").collect()}
    if value not in known:
        raise ValueError(f"{path} has no output {value!r}, only {sorted(known)}")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{escape(tag)}={escape(value)}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "value string")
    return spark.read.schema("value string").text(folder.toString())


def copy_lines(spark: SparkSession, source: str | Sequence[str], target: str) -> None:
    """Copy text lines unchanged, for instance to another file system."""
    write_lines(read_lines(spark, source), target)
