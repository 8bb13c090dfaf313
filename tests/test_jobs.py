"""Whole jobs on small fixed inputs."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pyspark.sql import Observation

from rillflow.operators import map_records, route, route_output, tap, tapped
from rillflow.plans import jobs
from rillflow.sinks import file_batch_writer
from rillflow.sources import read_file_log, read_lines
from rillflow.streaming import run_to_end


def text(spark, path):
    return sorted(r.value for r in read_lines(spark, str(path)).collect())


def event_line(code, name="f"):
    return "\t".join([name] + ["f"] * 20 + [code, "z"])


EVENTS = [event_line(c, str(i)) for i, c in enumerate(["IN", "US", "IN", "-1", "IND", "X", "", "-2", "-1"])]


@pytest.fixture
def log_folder(spark, tmp_path):
    """Key/value rows as files, and the stream of them."""

    def make(rows):
        path = str(tmp_path / "log")
        spark.createDataFrame(rows, "key string, value string").write.mode("append").parquet(path)
        return read_file_log(spark, path, "key string, value string, topic string")

    return make


def test_prefix_outputs_in_one_pass(spark, words, tmp_path):
    jobs.write_prefix_outputs(words, str(tmp_path / "o"))
    assert text(spark, tmp_path / "o/prefix=A") == ["Aggressive", "Apprehensive"]
    assert text(spark, tmp_path / "o/prefix=B") == ["Bold", "Brilliant"]


def test_main_route(spark, words, tmp_path):
    rules = [("A", F.col("word").startswith("A")), ("B", F.col("word").startswith("B"))]
    jobs.write_main_route(words, str(tmp_path / "o"), rules)
    assert text(spark, tmp_path / "o") == ["Aggressive", "Apprehensive"]
    assert route_output(route(words, rules), "B").count() == 2


def test_first_rule_wins_and_unmatched_rows_are_dropped(spark):
    df = spark.createDataFrame([("AB",), ("B",), ("C",), (None,)], "word string")
    routed = route(df, [("a", F.col("word").startswith("A")), ("b", F.col("word").contains("B"))])
    assert {r.word: r.tag for r in routed.collect()} == {"AB": "a", "B": "b"}
    with pytest.raises(ValueError):
        route(df, [])


def test_union(spark, words, tmp_path):
    a, b = words.where("word like 'A%'"), words.where("word like 'B%'")
    jobs.write_union([a, b], str(tmp_path / "o"))
    assert text(spark, tmp_path / "o") == ["Aggressive", "Apprehensive", "Bold", "Brilliant"]


def test_co_group_lines(spark):
    notices = spark.createDataFrame(
        [("door-1", "三号窗口"), ("door-2", "四号窗口")], "k string, v string"
    )
    messages = spark.createDataFrame([("door-1", "kind=a"), ("door-3", "kind=b")], "k string, v string")
    inputs = {"notices": (notices, "k", "v"), "messages": (messages, "k", "v")}
    assert sorted(r.line for r in jobs.co_group_lines(inputs).collect()) == [
        "door-1;[三号窗口];[kind=a];",
        "door-2;[四号窗口];[];",
        "door-3;[];[kind=b];",
    ]
    assert all(r.line.endswith(";\r") for r in jobs.co_group_lines(inputs, trailing_cr=True).collect())


def test_group_lines(spark):
    df = spark.createDataFrame([("EMI", "Q"), ("EMI", "B"), ("SUB", "N")], "label string, name string")
    assert sorted(r.line for r in jobs.group_lines(df, "label", "name").collect()) == ["EMI : [B, Q]", "SUB : [N]"]


def test_field_counts(spark):
    df = spark.createDataFrame([("1,x",), ("2,x,more",), ("3,y",)], "value string")
    assert sorted(r.json for r in jobs.field_count_json(df).collect()) == ['{"x": "2"}', '{"y": "1"}']


def test_location_counts_whole_sampled_and_literal(spark):
    df = spark.createDataFrame([(v,) for v in EVENTS], "value string")
    assert sorted(r.json for r in jobs.location_count_json(df, sample=None).collect()) == ['{"IN":2}', '{"US":1}']
    literal = jobs.location_count_json(df, sample=None, literal=True)
    assert sorted(r.json for r in literal.collect()) == ['{"-1":2}', '{"-2":1}']
    many = spark.createDataFrame([(event_line("IN"),)] * 50, "value string").repartition(4)
    assert [r.json for r in jobs.location_count_json(many, sample=10).collect()] == ['{"IN":10}']


def test_dated_location_counts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "20191017.export.CSV.zip", "w") as z:
        z.writestr("20191017.export.CSV", "\n".join(EVENTS))
    jobs.write_dated_location_counts(
        spark, f"{tmp_path}/", ".export.CSV.zip", str(tmp_path / "o"), dt.date(2019, 10, 17), sample=None
    )
    assert text(spark, tmp_path / "o") == ['{"IN":2}', '{"US":1}']


def test_key_value_log(spark, log_folder, tmp_path):
    stream = log_folder([("k", "v"), (None, "v"), ("k", None)])
    run_to_end(jobs.key_value_log(stream, "text", {"path": str(tmp_path / "o")}, str(tmp_path / "c"), available_now=True))
    assert text(spark, tmp_path / "o") == ["k # null", "k # v", "null # v"]


ALARM = '{"alarmid":"1","alarmTitle":"t","deviceModel":"d","alarmSource":3,"alarmMsg":"m"}'


def test_alarm_table_with_quarantine(spark, log_folder, tmp_path):
    stream = log_folder([(None, ALARM), (None, "oops"), (None, '{"alarmSource":3.5}')])
    good, bad = file_batch_writer(str(tmp_path / "good")), file_batch_writer(str(tmp_path / "bad"))
    run_to_end(jobs.alarm_table(stream, good, str(tmp_path / "c"), bad, available_now=True))
    row = spark.read.parquet(str(tmp_path / "good")).drop("batch_id", "query_id").collect()
    assert [tuple(r) for r in row] == [("1", "t", "d", 3, "m")]
    assert {r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {"oops", '{"alarmSource":3.5}'}


def test_alarm_documents(spark, log_folder, tmp_path):
    stream = log_folder([(None, ALARM), (None, "oops"), (None, '{"alarmid":"2","other":1}')])
    bad = file_batch_writer(str(tmp_path / "bad"))
    run_to_end(jobs.alarm_documents(stream, "text", {"path": str(tmp_path / "o")}, str(tmp_path / "c"), available_now=True, bad=bad))
    assert text(spark, tmp_path / "o") == sorted([ALARM, '{"alarmid":"2"}'])
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["oops"]
    with pytest.raises(StreamingQueryException, match="bad record"):
        run_to_end(jobs.alarm_documents(stream, "text", {"path": str(tmp_path / "o2")}, str(tmp_path / "c2"), available_now=True))


def test_alarm_documents_as_rows(spark, log_folder, tmp_path):
    stream = log_folder([(None, ALARM)])
    run_to_end(jobs.alarm_documents(stream, "parquet", {"path": str(tmp_path / "o")}, str(tmp_path / "c"), available_now=True))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [("1", "t", "d", 3, "m")]


def test_bad_rows_and_required_columns_fail_the_batch(spark, tmp_path):
    batch = spark.createDataFrame([(ALARM,), ("oops",), ('{"alarmid":"2"}',)], "value string")
    good, bad = file_batch_writer(str(tmp_path / "good")), file_batch_writer(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="bad record"):
        jobs.outcome_writer(good, None)(batch, 0)
    with pytest.raises(Exception, match="NULL in alarmMsg"):
        jobs.outcome_writer(good, bad, required=["alarmid", "alarmMsg"])(batch, 1)
    jobs.outcome_writer(good, bad, required=["alarmid"])(batch, 2)
    assert spark.read.parquet(str(tmp_path / "good")).where("batch_id = 2").count() == 2


def test_words_of_a_file(spark, tmp_path):
    (tmp_path / "w.txt").write_text("a  b c \n\n d\n")
    assert sorted(r.word for r in jobs.file_words(spark, str(tmp_path / "w.txt")).collect()) == list("abcd")


def test_bytes_there_and_back(spark, tmp_path):
    path = str(tmp_path / "stream")
    numbers = spark.range(10).select(F.col("id").cast("string").alias("value"))
    jobs.send_bytes(numbers, "parquet", {"path": path})
    assert {r.key for r in spark.read.parquet(path).collect()} == {"pkey"}
    stream = read_file_log(spark, path, "key string, value binary")
    got = jobs.receive_bytes(stream).collect()
    assert sorted(bytes(r.value) for r in got) == [str(i).encode() for i in range(10)]


def test_queue_fan_out(spark, log_folder, tmp_path):
    stream = log_folder([("k", line) for line in EVENTS])
    jobs.queue_to_lines_and_counts(
        stream, "text", {"path": str(tmp_path / "india")}, "text", {"path": str(tmp_path / "docs")}
    )
    assert text(spark, tmp_path / "india") == sorted([EVENTS[0], EVENTS[2]])
    assert [json.loads(d) for d in text(spark, tmp_path / "docs")] == [{"IN": 2}, {"US": 1}]


def test_copy_dated_lines(spark, tmp_path):
    (tmp_path / "20240101.csv").write_text("x\ny\n")
    jobs.copy_dated_lines(spark, f"{tmp_path}/", ".csv", str(tmp_path / "o"), dt.date(2024, 1, 1))
    assert text(spark, tmp_path / "o") == ["x", "y"]


def test_tap_counts_without_changing_the_flow(spark, words):
    tapped, seen = tap(words, "seen")
    assert tapped.count() == 4
    assert seen.get == {"n": 4}


def test_streams_are_tapped_by_name(log_folder, tmp_path):
    stream, none = tap(log_folder([("a", "b"), ("c", "d")]), "seen")
    query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run_to_end(query)
    assert none is None and tapped(query, "seen") == 2


def test_job_counts_what_it_read(spark):
    seen = Observation("read")
    lines = spark.createDataFrame([(v,) for v in EVENTS], "value string")
    jobs.location_count_json(lines, seen=seen).collect()
    assert seen.get == {"n": len(EVENTS)}


def test_pages_are_named_in_lines(spark):
    many = spark.createDataFrame([("k", str(i)) for i in range(25)] + [("j", "x")], "k string, v string")
    one = spark.createDataFrame([("k", "r")], "k string, v string")
    lines = [r.line for r in jobs.group_lines(many, "k", "v", 10).collect()]
    assert "j : [x]" in lines and {x.rpartition(" ")[2] for x in lines if x.startswith("k")} <= {"page=0", "page=1", "page=2"}
    lines = [r.line for r in jobs.co_group_lines({"a": (many, "k", "v"), "b": (one, "k", "v")}, page_size=10).collect()]
    assert "j;[x];[];" in lines and all("page=" in x for x in lines if x.startswith("k"))


def test_user_function_may_drop_and_multiply_rows(spark):
    def copies(batches):
        for batch in batches:
            yield batch.loc[batch.index.repeat(batch["id"])]

    assert sorted(r.id for r in map_records(spark.range(4), copies, "id bigint").collect()) == [1, 2, 2, 3, 3, 3]

    def same(batches):
        yield from batches

    assert map_records(spark.range(4), same, "id bigint", arrow=True).count() == 4
