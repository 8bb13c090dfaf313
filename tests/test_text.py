import random
import re

import pytest
from pyspark.sql import functions as F

from rillflow.functions import (
    delimited_field,
    key_value_text,
    location_code,
    to_text,
    to_utf8,
    tokens,
    utf16_length,
    valid_location,
)
from rillflow.operators import extract_field, tokenise, with_location


def java_split(line, pattern):
    """Split that drops trailing empty fields, but keeps a line without delimiter as one field."""
    parts = re.split(pattern, line)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def expected_location(line):
    fields = java_split(line, r"\t+")
    if len(fields) <= 22:
        return "NA"
    code = fields[21]
    return code if len(code) <= 2 else code[:1]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


EDGE = ["\t".join(["f"] * 21 + [code, "z"]) for code in ("IN", "-1", "IND", "X", "", "NA", "é1", "a\n")] + [
    "",
    "\t\t\t",
    "\t".join(["f"] * 22) + "\t",
    "\t" + "\t".join(["f"] * 20 + ["US", "z", "y", "", "w"]),
    "\t".join(["f"] * 21 + ["IN", "", "", "q"]),
]


def test_location_code_edge_rows(spark):
    rows = with_location(lines(spark, EDGE)).collect()
    assert [(r.value, r.location) for r in rows] == [(v, expected_location(v)) for v in EDGE]


def test_location_code_random_lines(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("\t\t\tab-NI") for _ in range(rng.randint(0, 120))) for _ in range(3000)]
    rows = with_location(lines(spark, values)).collect()
    assert [r.location for r in rows] == [expected_location(v) for v in values]
    assert len({r.location for r in rows}) > 5


def test_location_code_positional(spark):
    def expected(line):
        fields = java_split(line, "\t")
        return "NA" if len(fields) <= 22 else fields[21] if len(fields[21]) <= 2 else fields[21][:1]

    rng = random.Random(8)
    values = EDGE + ["".join(rng.choice("\tab\t") for _ in range(rng.randint(20, 90))) for _ in range(2000)]
    rows = with_location(lines(spark, values), collapse=False).collect()
    assert [r.location for r in rows] == [expected(v) for v in values]


def test_valid_location(spark):
    codes = ["IN", "NA", "-1", "--", "I", "", "IND", "\U0001d11e", "é1"]
    rows = lines(spark, codes).select(
        valid_location(F.col("value")).alias("kept"), valid_location(F.col("value"), literal=True).alias("literal")
    )
    assert [(r.kept, r.literal) for r in rows.collect()] == [
        (True, False),
        (False, False),
        (False, True),
        (False, True),
        (False, False),
        (False, False),
        (False, False),
        (True, False),
        (True, False),
    ]


def test_location_of_null_line(spark):
    assert with_location(lines(spark, [None])).first().location == "NA"


@pytest.mark.parametrize("line,field", [("a,b", "b"), ("a,,b", ""), (",b", "b"), ("a,b,,", "b"), ("a,b,c,d", "b")])
def test_field(spark, line, field):
    assert extract_field(lines(spark, [line])).first().field == field


@pytest.mark.parametrize("line", ["a,", "a", "", ",,,", None])
def test_short_line_fails_or_is_skipped(spark, line):
    with pytest.raises(Exception, match="no field 1"):
        extract_field(lines(spark, [line])).collect()
    assert extract_field(lines(spark, [line, "x,y"]), on_short="skip").collect()[0].field == "y"
    assert extract_field(lines(spark, [line]), on_short="skip").count() == 0


def test_field_random_lines(spark):
    rng = random.Random(9)
    values = ["".join(rng.choice(",ab") for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    for index in (0, 1, 3):
        rows = lines(spark, values).select(delimited_field(F.col("value"), index, on_short="null").alias("f")).collect()
        fields = [java_split(v, ",") for v in values]
        # A line of delimiters only has no fields; its field 0 is taken as empty.
        want = [f[index] if len(f) > index else ("" if index == 0 and not f else None) for f in fields]
        assert [r.f for r in rows] == want


def test_header_is_data_unless_named(spark):
    data = lines(spark, ["id,name", "1,x"])
    assert extract_field(data).count() == 2
    assert [r.field for r in extract_field(data, header="id,name").collect()] == ["x"]


def test_other_delimiters_are_literal(spark):
    assert lines(spark, ["a|b|c", "a.b|d"]).select(delimited_field(F.col("value"), 1, "|").alias("f")).collect()[0].f == "b"


def test_tokens(spark):
    df = lines(spark, ["a  b c ", " ", "", "d"])
    assert [r.word for r in tokenise(df).collect()] == ["a", "b", "c", "d"]
    assert df.select(tokens(F.col("value")).alias("t")).first().t == ["a", "b", "c"]


def test_key_value_text(spark):
    df = spark.createDataFrame([("k", "v"), (None, "v"), ("k", None)], "key string, value string")
    rows = df.select(key_value_text(F.col("key"), F.col("value")).alias("t")).collect()
    assert [r.t for r in rows] == ["k # v", "null # v", "k # null"]


def test_bytes_round_trip(spark):
    df = spark.range(10).select(to_utf8(F.col("id")).alias("data"))
    assert [bytes(r.data) for r in df.collect()] == [str(i).encode() for i in range(10)]
    assert [r.t for r in df.select(to_text(F.col("data")).alias("t")).collect()] == [str(i) for i in range(10)]


def test_utf16_length(spark):
    rows = lines(spark, ["", "ab", "é", "\U0001d11e", "a\U0001d11e"]).select(utf16_length(F.col("value")).alias("n")).collect()
    assert [r.n for r in rows] == [0, 2, 1, 2, 3]


def test_location_code_is_a_plain_expression(spark):
    df = lines(spark, EDGE).where(location_code(F.col("value")) == "IN")
    assert df.count() == 2
