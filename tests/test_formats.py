from pyspark.sql import functions as F

from rillflow.functions import co_group_line, count_document, count_json, group_line


def one(df, column):
    return df.select(column.alias("v")).first().v


def test_count_json(spark):
    df = spark.createDataFrame([("x", 3, 'a"b')], "k string, n bigint, q string")
    k, n, q = F.col("k"), F.col("n"), F.col("q")
    assert one(df, count_json(k, n, quoted=True)) == '{"x": "3"}'
    assert one(df, count_json(k, n)) == '{"x":3}'
    assert one(df, count_json(q, n)) == '{"a"b":3}'
    assert one(df, count_json(q, n, escape=True)) == '{"a\\"b":3}'
    assert one(df, count_json(q, n, quoted=True, escape=True)) == '{"a\\"b":"3"}'
    assert one(df, count_document(q, n)) == '{"a\\"b":3}'


def test_group_lines(spark):
    df = spark.createDataFrame([("EMI", ["B", "Q"], [], [None, "x"])], "k string, a array<string>, b array<string>, c array<string>")
    k, a, b, c = (F.col(name) for name in "kabc")
    assert one(df, group_line(k, a)) == "EMI : [B, Q]"
    assert one(df, group_line(k, c)) == "EMI : [null, x]"
    assert one(df, co_group_line(k, [a, b])) == "EMI;[B, Q];[];"
    assert one(df, co_group_line(k, [a, b, a], trailing_cr=True)) == "EMI;[B, Q];[];[B, Q];\r"
