import json

import pytest
from pyspark.sql import functions as F

from rillflow.functions import to_record_json
from rillflow.functions.records import ALARM_SCHEMA
from rillflow.operators import parse_records, require_non_null, tag_records

GOOD = {
    '{"alarmid":"1","alarmTitle":"t","deviceModel":"d","alarmSource":3,"alarmMsg":"m"}': ("1", "t", "d", 3, "m"),
    '{"alarmid":1,"alarmSource":"3","extra":9}': ("1", None, None, 3, None),
    '{"alarmSource":3.0}': (None, None, None, 3, None),
    '{"alarmSource":1e3}': (None, None, None, 1000, None),
    '{"alarmSource":null}': (None, None, None, None, None),
    '{"ALARMID":"x"}': (None, None, None, None, None),
    "{}": (None, None, None, None, None),
    "{'alarmid':'q'}": ("q", None, None, None, None),
    '{alarmid:"q"} ': ("q", None, None, None, None),
    '{"alarmMsg":"摄像机 \\u00e9"}': (None, None, None, None, "摄像机 é"),
}
BAD = [
    '{"alarmSource":3.5}',
    '{"alarmSource":"x"}',
    '{"alarmSource":9999999999}',
    '{"alarmSource":true}',
    '{"alarmSource":"NaN"}',
    "not json",
    "null",
    "",
    "  ",
    None,
    '[{"alarmid":"q"}]',
    '{"alarmid":',
    '{"alarmid":"1"} trailing',
    '{"alarmid":"1"}{"x":2}',
    '{"alarmid":"1"} junk}',
    '{"alarmid":"1"},{"alarmid":"2"}',
    '{"alarmid":"1"}}',
    '{"alarmid":"1"}]',
    "3",
    '"text"',
]


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame([(v,) for v in [*GOOD, *BAD]], "value string")


def test_quarantine_splits_good_and_bad(mixed):
    good, bad = parse_records(mixed)
    assert sorted(map(repr, (tuple(r) for r in good.collect()))) == sorted(map(repr, GOOD.values()))
    assert sorted(map(repr, (r.value for r in bad.collect()))) == sorted(map(repr, BAD))
    assert good.schema.names == ALARM_SCHEMA.names
    assert [f.dataType for f in good.schema] == [f.dataType for f in ALARM_SCHEMA]


def test_drop_keeps_the_good_rows(mixed):
    assert parse_records(mixed, on_bad="drop").count() == len(GOOD)


def test_fail_stops_at_a_bad_row(spark, mixed):
    with pytest.raises(Exception, match="bad record"):
        parse_records(mixed, on_bad="fail").collect()
    fine = spark.createDataFrame([(v,) for v in GOOD], "value string")
    assert parse_records(fine, on_bad="fail").count() == len(GOOD)


def test_unknown_policy_is_refused(mixed):
    with pytest.raises(ValueError):
        parse_records(mixed, on_bad="ignore")


def test_outcomes_are_written_in_one_pass(spark, mixed, tmp_path):
    tag_records(mixed).write.partitionBy("outcome").parquet(str(tmp_path / "o"))
    counts = {r.outcome: r["count"] for r in spark.read.parquet(str(tmp_path / "o")).groupBy("outcome").count().collect()}
    assert counts == {"good": len(GOOD), "bad": len(BAD)}


def test_reasons(spark):
    rows = [('{"alarmSource":"3"}',), ('{"alarmTitle":"t"}',), ('{"alarmSource":null,"alarmTitle":"t"}',), ('{"alarmSource":"x"}',), ("nothing",), (None,)]
    df = spark.createDataFrame(rows, "value string")
    got = {r.value: (r.outcome, r.reason, r.record and r.record.alarmSource) for r in tag_records(df, required=("alarmSource", "alarmTitle")).collect()}
    assert got == {
        rows[0][0]: ("bad", "NULL in alarmTitle", None),
        rows[1][0]: ("bad", "NULL in alarmSource", None),
        rows[2][0]: ("bad", "NULL in alarmSource", None),
        rows[3][0]: ("bad", "malformed", None),
        "nothing": ("bad", "malformed", None),
        None: ("bad", "malformed", None),
    }
    assert [(r.outcome, r.reason) for r in tag_records(df.limit(1)).collect()] == [("good", None)]
    with pytest.raises(ValueError, match="no such"):
        tag_records(df, required=("nothing",))


def test_parsing_happens_once(spark, mixed):
    plan = parse_records(mixed, on_bad="drop")._jdf.queryExecution().optimizedPlan().toString()
    # Once for the fields, once for the number of objects.
    assert plan.count("from_json") == 2


def test_serialising_leaves_nulls_out(spark):
    df = spark.createDataFrame([("1", None, 'say "x"')], "alarmid string, alarmTitle string, alarmMsg string")
    doc = df.select(to_record_json("alarmid", "alarmTitle", "alarmMsg").alias("doc")).first().doc
    assert doc == '{"alarmid":"1","alarmMsg":"say \\"x\\""}'
    assert json.loads(doc) == {"alarmid": "1", "alarmMsg": 'say "x"'}


def test_round_trip(spark):
    rows = spark.createDataFrame([("1", "t", "d", 3, "m"), ("2", None, None, None, None)], ALARM_SCHEMA)
    text = rows.select(to_record_json(*ALARM_SCHEMA.names).alias("value"))
    assert sorted(map(repr, parse_records(text, on_bad="fail").collect())) == sorted(map(repr, rows.collect()))


def test_require_non_null(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "x string, y int")
    with pytest.raises(Exception, match="NULL in y"):
        require_non_null(df).collect()
    assert require_non_null(df, "x").count() == 2
    assert require_non_null(df.where(F.col("y").isNotNull())).collect()[0].y == 1
