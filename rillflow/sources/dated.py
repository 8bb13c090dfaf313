"""Sources whose path holds a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.sources.archive import read_zip_lines
from rillflow.sources.text import read_lines

# Fixed value: the date part of a path is yyyyMMdd.
PATH_DATE = "%Y%m%d"


def dated_paths(
    base: str,
    suffix: str = "",
    start: dt.date | None = None,
    end: dt.date | None = None,
    explicit: str | None = None,
) -> list[str]:
    """``base + yyyyMMdd + suffix`` for every day from ``start`` to ``end``, both included.

    ``start`` defaults to today and ``end`` to ``start``. An ``explicit`` path wins over the dates.
    """
    if explicit is not None:
        return [explicit]
    first = start or dt.date.today()
    last = end or first
    if last < first:
        raise ValueError(f"end {last} is before start {first}")
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    return [f"{base}{day.strftime(PATH_DATE)}{suffix}" for day in days]


def present_days(spark: SparkSession, base: str, suffix: str = "") -> dict[dt.date, str]:
    """The days for which ``base + yyyyMMdd + suffix`` exists, and their paths, from one listing."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{base}{'[0-9]' * 8}{suffix}")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    out = {}
    for status in found or []:
        path = status.getPath().toString()
        digits = path[: len(path) - len(suffix)][-8:] if suffix else path[-8:]
        try:
            out[dt.datetime.strptime(digits, PATH_DATE).date()] = path
        except ValueError:
            continue  # eight digits that are no day
    return dict(sorted(out.items()))


def read_dated_lines(
    spark: SparkSession,
    base: str,
    suffix: str = "",
    start: dt.date | None = None,
    end: dt.date | None = None,
    explicit: str | None = None,
    missing: str = "fail",
) -> DataFrame:
    """Lines of the dated files; only the named days are read.

    ``missing`` says what happens where days of the range have no path: ``fail`` names them all before anything is read,
    ``skip`` reads the others, none giving no lines. Each file below the paths is read by its own name: members of zip archives,
    and lines of all others, which Spark unpacks by their suffix.
    """
    if missing not in ("fail", "skip"):
        raise ValueError("missing must be 'fail' or 'skip'")
    paths = dated_paths(base, suffix, start, end, explicit)
    if explicit is None:
        present = present_days(spark, base, suffix)
        days = [(start or dt.date.today()) + dt.timedelta(days=i) for i in range(len(paths))]
        absent = [day.isoformat() for day in days if day not in present]
        if absent and missing == "fail":
            raise FileNotFoundError(f"{base}<day>{suffix} does not exist for {', '.join(absent)}")
        paths = [present[day] for day in days if day in present]
        if not paths:
            return spark.createDataFrame([], "value string")
    if all(path.lower().endswith(".zip") for path in paths):
        return read_zip_lines(spark, paths)
    # The condition on the file name keeps archives out of the scan.
    plain = read_lines(spark, paths).where(~F.lower("_metadata.file_name").endswith(".zip"))
    return plain.union(read_zip_lines(spark, paths))
