"""Tasks that fail after part of their output, as when an executor is lost: results stay whole."""

from collections import Counter

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from rillflow.operators import co_group, group_by_key
from rillflow.plans import checks
from rillflow.sources import read_zip_lines
from rillflow.streaming import read_bounded


def flaky(df):
    """The same rows, but the first attempt of every task fails at its end."""

    def fail_once(batches):
        yield from batches
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("executor lost")

    return df.mapInArrow(fail_once, df.schema)


@pytest.fixture
def rows(spark):
    return spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") % 400).cast("string").alias("v"),
    )


def test_groups(rows):
    want = Counter((r.k, r.v) for r in rows.collect())
    grouped = group_by_key(flaky(rows), "k", "v", 100).collect()
    assert Counter((r.k, v) for r in grouped for v in r["values"]) == want
    both = co_group({"a": (flaky(rows), "k", "v"), "b": (rows, "k", "v")}, 100).collect()
    assert Counter((r.key, v) for r in both for v in r.a) == want == Counter((r.key, v) for r in both for v in r.b)


def test_zip_archives(spark, rows):
    lines = rows.select("v")
    path = checks.written_zips(spark, flaky(lines), "v")
    read = flaky(read_zip_lines(spark, path, tasks=3))
    assert Counter(r.value for r in read.collect()) == Counter(r.v for r in rows.collect())


def test_landed_streams(spark, rows, tmp_path):
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    assert read_bounded(flaky(stream)).count() == 3000
