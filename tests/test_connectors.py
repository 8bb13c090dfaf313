"""A small log connector, to show that sources and sinks work with any format name.

It stands in for the real log, queue and document connectors, which are not part of Spark itself.
A log is a folder of JSON-line files; offsets are file numbers, and each file has a time in its name.
"""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage

from rillflow.operators import strip_metadata
from rillflow.plans import jobs
from rillflow.sinks import log_rows, write_documents, write_log
from rillflow.sources import read_log
from rillflow.streaming import read_bounded


class FolderLog(DataSource):
    @classmethod
    def name(cls):
        return "folderlog"

    def schema(self):
        return "key binary, value binary, topic string"

    def streamReader(self, schema):
        return FolderLogReader(self.options)

    def writer(self, schema, overwrite):
        return FolderLogWriter(self.options, schema.names)


class FolderLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder, self.options = options["path"], dict(options)

    def _files(self):
        return sorted(name for name in os.listdir(self.folder) if name.endswith(".json"))

    def initialOffset(self):
        if "startingtimestamp" in self.options:
            start = int(self.options["startingtimestamp"])
            return {"file": sum(int(name.removesuffix(".json").split("-")[1]) < start for name in self._files())}
        return {"file": 0 if self.options["startingoffsets"] == "earliest" else len(self._files())}

    def latestOffset(self):
        return {"file": len(self._files())}

    def partitions(self, start, end):
        return [InputPartition(f"{self.folder}/{name}") for name in self._files()[start["file"] : end["file"]]]

    def read(self, partition):
        with open(partition.value) as file:
            for line in file:
                key, value = json.loads(line)
                yield (None if key is None else bytearray(key.encode()), bytearray(value.encode()), "topic")

    def commit(self, end):
        pass


class FolderLogWriter(DataSourceWriter):
    def __init__(self, options, columns):
        self.folder, self.columns = options["path"], columns

    def write(self, rows):
        with open(f"{self.folder}/{uuid.uuid4().hex}.out", "w") as file:
            for row in rows:
                record = row.asDict()
                file.write(json.dumps({k: bytes(v).decode() if isinstance(v, (bytes, bytearray)) else v for k, v in record.items()}) + "\n")
        return WriterCommitMessage()


@pytest.fixture
def log(spark, tmp_path):
    from pyspark import cloudpickle
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FolderLog)
    folder = tmp_path / "log"
    folder.mkdir()

    def add(number, millis, records):
        (folder / f"{number:04d}-{millis}.json").write_text("".join(json.dumps(r) + "\n" for r in records))

    return str(folder), add


def written(folder):
    rows = []
    for name in os.listdir(folder):
        if name.endswith(".out"):
            with open(f"{folder}/{name}") as file:
                rows += [json.loads(line) for line in file]
    return sorted(rows, key=str)


def landed(stream, n):
    return sorted(bytes(r.value).decode() for r in read_bounded(stream, max_records=n, follow=True).collect())


def test_start_positions(spark, log):
    folder, add = log
    time = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    millis = int(time.timestamp() * 1000)
    add(1, millis - 1, [["k", "before"]])
    add(2, millis, [["k", "at"], [None, "at too"]])
    options = {"path": folder}
    assert landed(read_log(spark, options, "folderlog"), 3) == ["at", "at too", "before"]
    assert landed(read_log(spark, options, "folderlog", start=time), 2) == ["at", "at too"]


def test_key_value_job_between_logs(spark, log, tmp_path):
    folder, add = log
    add(1, 0, [["k", "v"], [None, "w"]])
    out = tmp_path / "topic"
    out.mkdir()
    landed_rows = read_bounded(read_log(spark, {"path": folder}, "folderlog"), max_records=2, follow=True)
    rows = strip_metadata(landed_rows)
    write_log(log_rows(rows, F.concat_ws(" # ", F.coalesce("key", F.lit("null")), "value")), "folderlog", {"path": str(out)})
    assert written(str(out)) == [{"value": "k # v"}, {"value": "null # w"}]


def test_queue_is_read_once_for_both_outputs(spark, log, tmp_path):
    folder, add = log
    line = "\t".join(["f"] * 21 + ["IN", "z"])
    add(1, 0, [["k", line]] * 3)
    lines, docs = tmp_path / "india", tmp_path / "docs"
    lines.mkdir()
    docs.mkdir()
    jobs.queue_to_lines_and_counts(
        read_log(spark, {"path": folder}, "folderlog"),
        "folderlog",
        {"path": str(lines)},
        "folderlog",
        {"path": str(docs)},
        max_records=3,
        follow=True,
    )
    assert written(str(lines)) == [{"value": line}] * 3
    assert written(str(docs)) == [{"location": "IN", "n": 3}]


def test_keyed_bytes_and_documents_with_ids(spark, log):
    folder, _ = log
    jobs.send_bytes(spark.range(2).select(F.col("id").alias("value")), "folderlog", {"path": folder})
    assert written(folder) == [{"key": "pkey", "value": "0"}, {"key": "pkey", "value": "1"}]
    df = spark.createDataFrame([(7, "{}")], "id int, doc string")
    write_documents(df, "folderlog", {"path": folder}, id_col="id")
    assert {"id": 7, "doc": "{}"} in written(folder)
