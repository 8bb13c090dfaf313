"""Counting, grouping and co-grouping by key.

``count_per_element`` combines before the shuffle, so hot elements cost nothing extra. Grouping
cannot combine: its result holds every value. A group is therefore kept as *pages* of about
``page_size`` values or ``page_bytes`` bytes, whichever are fewer, one row each. A group that fits in one
page is one row, page 0; a larger one has pages 0, 1, 2, ... which together hold all its values. No task ever
holds more than its pages. Which values share a page depends on how the input is dealt out to tasks. The input is read
once to measure the groups, and once to group them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.sets import flatten
from rillflow.workspace import land

PAGE_SIZE = 10_000
PAGE_BYTES = 64 * 1024 * 1024
# Hot keys are broadcast up to this many bytes, and joined by shuffle beyond.
BROADCAST_BYTES = 32 * 1024 * 1024


def count_per_element(df: DataFrame, *elements: str, alias: str = "n") -> DataFrame:
    """Number of occurrences of each distinct element."""
    return df.groupBy(*elements).agg(F.count(F.lit(1)).alias(alias))


def group_by_key(df: DataFrame, key: str, value: str, page_size: int = PAGE_SIZE, alias: str = "values", page_bytes: int = PAGE_BYTES) -> DataFrame:
    """``(key, page, values, size)``: all values of each key, duplicates kept, sorted within a page.

    ``size`` is the number of values of the whole group. NULL is a key like any other. Batch input only; it is read
    once more to measure the groups.
    """
    if key in ("page", "size", alias):
        raise ValueError(f"the key column must not be named {key}")
    grouped = co_group({alias: (df, key, value)}, page_size, page_bytes)
    return grouped.select(F.col("key").alias(key), "page", alias, F.col("sizes")[alias].alias("size"))


def co_group(inputs: Mapping[str, tuple[DataFrame, str, str]], page_size: int = PAGE_SIZE, page_bytes: int = PAGE_BYTES) -> DataFrame:
    """``(key, page, <one list per input>, sizes)`` for every key that occurs in any input.

    ``inputs`` maps the name of each output list to its ``(DataFrame, key column, value column)``. Lists are not
    multiplied with each other. ``sizes`` has the number of values of the key in each input: where it is zero the
    input lacks the key, otherwise an empty list means that the values are on other pages.
    """
    if page_size < 1 or page_bytes < 1:
        raise ValueError("page_size and page_bytes must be positive")
    names = list(inputs)
    if {"key", "page", "sizes"} & set(names):
        raise ValueError("lists must not be named key, page or sizes")
    if any(df.isStreaming for df, _, _ in inputs.values()):
        raise ValueError("groups of a stream never end; land it first, for instance with read_bounded")
    lists = [f"list_{i}" for i in range(len(names))]
    tagged = [
        df.select(F.col(key).alias("key"), F.lit(i).alias("tag"), *_value_columns(inputs, lists, i, F.col(value)))
        for i, (df, key, value) in enumerate(inputs.values())
    ]
    rows = flatten(*tagged)
    hot = _hot_keys(rows, lists, page_size, page_bytes)
    paged = rows.select("*", F.lit(0).cast("bigint").alias("page")) if hot is None else _paged(rows, hot, lists)
    grouped = paged.groupBy("key", "page").agg(*[_page_values(i, column).alias(name) for i, (column, name) in enumerate(zip(lists, names))])
    own = [F.size(name).cast("bigint") for name in names]
    if hot is not None:
        grouped = grouped.join(hot, grouped["key"].eqNullSafe(hot["hot_key"]), "left")
        own = [F.coalesce(F.get("sizes_by_tag", F.lit(i)), n) for i, n in enumerate(own)]
    return grouped.select("key", "page", *names, F.struct(*[n.alias(name) for n, name in zip(own, names)]).alias("sizes"))


def _value_columns(inputs: Mapping, lists: list[str], own: int, value: Column) -> list[Column]:
    """The value in the column of its own input, NULL of the right type in the others."""
    types = [df.schema[value_name].dataType for df, _, value_name in inputs.values()]
    return [(value if i == own else F.lit(None).cast(types[i])).alias(name) for i, name in enumerate(lists)]


def _value_bytes(rows: DataFrame, column: str) -> Column:
    """Size of a value; numbers and times count as eight bytes."""
    kind = rows.schema[column].dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    return F.octet_length(_as_text(rows, column)) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else F.lit(8)


def _hot_keys(rows: DataFrame, lists: list[str], page_size: int, page_bytes: int) -> DataFrame | None:
    """Keys with more than one page in any input, with sizes and page counts by input, or None when there are none.

    The sums combine before their shuffle. Only the hot keys are stored.
    """
    spark = rows.sparkSession
    own = [F.col("tag") == i for i in range(len(lists))]
    counts = [F.count_if(mine).alias(f"n_{i}") for i, mine in enumerate(own)]
    volumes = [F.sum(F.when(mine, _value_bytes(rows, name))).alias(f"b_{i}") for i, (mine, name) in enumerate(zip(own, lists))]
    sizes = rows.groupBy("key").agg(*counts, *volumes)
    pages = [
        F.greatest(F.lit(1), F.ceil(F.col(f"n_{i}") / F.lit(page_size)), F.ceil(F.coalesce(f"b_{i}", F.lit(0)) / F.lit(page_bytes))).cast("bigint")
        for i in range(len(lists))
    ]
    measured = sizes.select(F.col("key").alias("hot_key"), F.array(*[f"n_{i}" for i in range(len(lists))]).alias("sizes_by_tag"), F.array(*pages).alias("pages_by_tag"))
    hot = land(measured.where(F.array_max("pages_by_tag") > 1), "hot-groups")
    key_bytes = F.coalesce(F.octet_length(F.to_json(F.struct("hot_key"))), F.lit(0)) + F.lit(32 * len(lists))
    n, size = hot.agg(F.count(F.lit(1)), F.sum(key_bytes)).first()
    if n == 0:
        return None
    return F.broadcast(hot) if size <= BROADCAST_BYTES else hot


def _paged(rows: DataFrame, hot: DataFrame, lists: list[str]) -> DataFrame:
    """All rows with their page: 0 for ordinary groups, and for hot ones dealt out by every task in turn.

    A task sorts its rows of hot groups first, so that a task that runs again deals them out in the same way
    whatever order they come in, and begins each group at a page of its own. Values and copies fill the pages alike.
    """
    pages = F.coalesce(F.element_at("pages_by_tag", F.col("tag") + 1), F.lit(1))
    routed = rows.join(hot, rows["key"].eqNullSafe(hot["hot_key"]), "left").select(*rows.columns, pages.alias("pages"))
    is_hot = F.col("pages") > 1
    # Ordinary rows are all alike to the sort.
    ordered = routed.sortWithinPartitions(*[F.when(is_hot, F.col(c)) for c in ("key", "tag", *lists)])
    first = F.pmod(F.xxhash64(F.spark_partition_id(), "key", "tag"), "pages")
    turn = F.pmod(first + F.monotonically_increasing_id() % F.col("pages"), "pages")
    return ordered.withColumn("page", F.when(is_hot, turn).otherwise(F.lit(0))).select(*rows.columns, "page")


def _as_text(df: DataFrame, column: str) -> Column:
    nested = isinstance(df.schema[column].dataType, (T.StructType, T.ArrayType, T.MapType))
    return F.to_json(column) if nested else F.col(column).cast("string")


def _page_values(tag: int, column: str) -> Column:
    """The values of one input in a page, sorted, NULLs first.

    Rows of other inputs are NULL in ``column`` and drop out of the list; own NULLs are counted.
    """
    value = F.col(column)
    nulls = F.count_if((F.col("tag") == tag) & value.isNull()).cast("int")
    collected = F.sort_array(F.collect_list(value))
    return F.when(nulls == 0, collected).otherwise(F.concat(F.array_repeat(F.get(collected, F.size(collected)), nulls), collected))
