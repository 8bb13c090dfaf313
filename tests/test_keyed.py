import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rillflow.operators import cap_rows, co_group, count_per_element, flatten, group_by_key, take_any
from rillflow.operators import keyed


TASKS = 5


def assert_groups(rows, df, key, page_size):
    """Brute force: all values of all groups, each once, on the right number of pages of about the right size."""
    by_key, got = defaultdict(list), defaultdict(list)
    for k, value in rows:
        by_key[k].append(value)
    found = df.collect()
    assert len(found) == len({(r[key], r.page) for r in found})
    for r in found:
        n_pages = math.ceil(len(by_key[r[key]]) / page_size)
        assert 0 <= r.page < n_pages and r["size"] == len(by_key[r[key]])
        assert r["values"] == sorted(r["values"], key=lambda x: (x is not None, x))
        got[r[key]] += r["values"]
        # Tasks deal out in turn, so a page has at most a value more per task than its share.
        assert len(r["values"]) <= math.ceil(r["size"] / n_pages) + TASKS
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in by_key.items()}


def collected(df, key):
    return {(r[key], r.page): r["values"] for r in df.collect()}


def test_count_per_element(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "v string")
    assert {r.v: r.n for r in count_per_element(df, "v").collect()} == {"x": 2, "y": 1, None: 1}


def test_small_groups_are_one_row_each(spark):
    df = spark.createDataFrame([("EMI", "Q"), ("EMI", "B"), ("SUB", "N"), ("EMI", "Q")], "label string, name string")
    assert collected(group_by_key(df, "label", "name"), "label") == {("EMI", 0): ["B", "Q", "Q"], ("SUB", 0): ["N"]}


@pytest.mark.parametrize("page_size", [1, 7, 50, 100_000])
def test_groups_against_brute_force(spark, page_size):
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + list("abcdefgh")), rng.choice([None, "same", *map(str, range(40))])) for _ in range(2000)]
    rows += [("copies", "one")] * 500 + [(None, "n")] * 60 + [("unique", str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(TASKS)
    assert_groups(rows, group_by_key(df, "k", "v", page_size), "k", page_size)


def test_pages_stay_near_their_size(spark):
    rows = [("hot", str(i)) for i in range(5000)] + [("copies", "x")] * 5000 + [("two", "x")] * 2500 + [("two", "y")] * 2500
    df = spark.createDataFrame(rows, "k string, v string")
    sizes = group_by_key(df, "k", "v", 100).select("k", F.size("values").alias("n")).collect()
    assert sum(r.n for r in sizes) == len(rows)
    # A value more per task at most.
    assert max(r.n for r in sizes) <= 100 + df.rdd.getNumPartitions()
    assert min(r.n for r in sizes) >= 100 - df.rdd.getNumPartitions()


def test_values_with_many_copies_are_dealt_out(spark):
    rows = [("k", "x")] * 1000 + [("k", "y")] * 10 + [("j", "z")] * 5
    df = spark.createDataFrame(rows, "k string, v string").repartition(TASKS)
    assert_groups(rows, group_by_key(df, "k", "v", 20), "k", 20)


def test_hot_keys_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    rows = [(k, str(i)) for k in ("a", None) for i in range(100)] + [("b", "1")]
    df = spark.createDataFrame(rows, "k string, v string")
    assert_groups(rows, group_by_key(df, "k", "v", 10), "k", 10)


def test_pages_do_not_depend_on_the_order_of_rows(spark, tmp_path):
    """A task that runs again may see its rows in another order; it must deal them out as before."""
    rows = [("k", str(i % 70)) for i in range(300)] + [("j", str(i)) for i in range(40)]
    pages = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        spark.createDataFrame(rows, "k string, v string").coalesce(1).write.parquet(f"{tmp_path}/{seed}")
        df = spark.read.parquet(f"{tmp_path}/{seed}")
        pages.append(sorted((r.k, r.page, r["values"]) for r in group_by_key(df, "k", "v", 10).collect()))
    assert pages[0] == pages[1] == pages[2]


def test_numbers_and_structs_as_values(spark):
    df = spark.createDataFrame([("a", i, (i, "x")) for i in range(30)], "k string, v int, s struct<i:int, t:string>")
    numbers = group_by_key(df, "k", "v", 8)
    assert sorted(v for r in numbers.collect() for v in r["values"]) == list(range(30))
    structs = group_by_key(df, "k", "s", 8)
    assert sorted(v.i for r in structs.collect() for v in r["values"]) == list(range(30))


def test_co_group_lists_per_input(spark):
    left = spark.createDataFrame([("k1", "a2"), ("k1", "a1"), ("k2", "a3"), (None, "a4")], "k string, v string")
    right = spark.createDataFrame([("k1", 1), ("k3", 2), (None, 3)], "k string, w int")
    rows = co_group({"left": (left, "k", "v"), "right": (right, "k", "w")}).collect()
    assert {r.key: (r.left, r.right) for r in rows} == {
        "k1": (["a1", "a2"], [1]),
        "k2": (["a3"], []),
        "k3": ([], [2]),
        None: (["a4"], [3]),
    }
    assert all(r.page == 0 for r in rows)


def test_co_group_pages_each_input_by_itself(spark):
    left = spark.createDataFrame([("k", str(i)) for i in range(95)] + [("j", "0")], "k string, v string")
    right = spark.createDataFrame([("k", "r"), ("j", "s")], "k string, v string")
    third = spark.createDataFrame([("k", "t")] * 25, "k string, v string")
    rows = co_group({"a": (left, "k", "v"), "b": (right, "k", "v"), "c": (third, "k", "v")}, 10).collect()
    lists = {name: Counter((r.key, v) for r in rows for v in r[name]) for name in "abc"}
    assert lists["a"] == Counter([("k", str(i)) for i in range(95)] + [("j", "0")])
    assert lists["b"] == Counter([("k", "r"), ("j", "s")])
    assert lists["c"] == Counter([("k", "t")] * 25)
    assert {r.page for r in rows if r.b} == {0}
    assert len([r for r in rows if r.key == "j"]) == 1


def test_page_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        group_by_key(spark.createDataFrame([("a", "b")], "k string, v string"), "k", "v", 0)


def test_flatten_keeps_duplicates(spark, words):
    a = words.where(F.col("word").startswith("A"))
    assert sorted(r.word for r in flatten(a, words, a).collect()) == sorted(
        ["Aggressive", "Apprehensive"] * 3 + ["Bold", "Brilliant"]
    )
    with pytest.raises(ValueError):
        flatten()


def test_take_any(spark):
    df = spark.range(0, 1000, 1, 8)
    taken = [r.id for r in take_any(df, 10).collect()]
    assert len(taken) == len(set(taken)) == 10
    assert take_any(df.limit(3), 10).count() == 3
    sample = take_any(df, 5, stable=True)
    assert sample.collect() == sample.collect()
    assert take_any(df, 2000).count() == 1000


@pytest.mark.parametrize("n", [0, 1, 124, 125, 126, 999, 1000, 5000])
def test_cap_rows(spark, n):
    capped = cap_rows(spark.range(0, 1000, 1, 8), n)
    rows = [r.id for r in capped.collect()]
    assert len(rows) == len(set(rows)) == min(n, 1000)
    assert "SinglePartition" not in capped.select("id")._jdf.queryExecution().executedPlan().toString().partition("BroadcastExchange")[0]


def test_sizes_tell_absent_from_elsewhere(spark):
    left = spark.createDataFrame([("k", str(i)) for i in range(95)], "k string, v string")
    right = spark.createDataFrame([("k", "r"), ("j", "s")], "k string, v string")
    rows = co_group({"a": (left, "k", "v"), "b": (right, "k", "v")}, 10).collect()
    assert {(r.key, tuple(r.sizes)) for r in rows} == {("k", (95, 1)), ("j", (0, 1))}
    assert {r["size"] for r in group_by_key(left, "k", "v", 10).collect()} == {95}


def test_pages_are_bounded_by_bytes(spark):
    rows = [("k", str(i) * 500) for i in range(10, 50)]
    df = spark.createDataFrame(rows, "k string, v string")
    pages = group_by_key(df, "k", "v", page_bytes=5000).collect()
    assert Counter(v for r in pages for v in r["values"]) == Counter(v for _, v in rows)
    assert len(pages) > 4 and max(sum(map(len, r["values"])) for r in pages) < 20_000


def test_sample_keeps_types_and_nulls(spark):
    schema = "a array<int>, s struct<x:string>, b binary, t timestamp_ntz, n int"
    df = spark.createDataFrame([([1], ("x",), b"b", None, None)], schema)
    assert take_any(df, 3).schema == df.schema and take_any(df, 3).collect() == df.collect()


def test_streams_are_refused(spark, tmp_path):
    stream = spark.readStream.schema("k string, v string").json(str(tmp_path))
    with pytest.raises(ValueError, match="stream"):
        group_by_key(stream, "k", "v")


def test_reserved_names_are_refused(spark):
    df = spark.createDataFrame([("a", "b")], "page string, v string")
    with pytest.raises(ValueError):
        group_by_key(df, "page", "v")
    with pytest.raises(ValueError):
        co_group({"page": (df, "v", "v")})
