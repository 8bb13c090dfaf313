"""Removing repeated runs of lines: a suffix array over line ids, by distributed prefix doubling.

Suffixes are ranked by their first 1, 2, 4, ... lines. A rank is the place of a pair of shorter ranks in a
range-partitioned sort of the distinct pairs, so equal ranks are equal runs, and ranks are in the order of the
runs. Only suffixes that share their rank with another one go on. The suffixes that still share a rank at
``min_lines`` are the intervals of the suffix array with a longest common prefix of at least that, and the
union of those that are not the first of their interval are the maximal repeated runs. What such an interval
is at more lines makes no difference to what is deleted, so the doubling ends there. On request shorter runs of
many words are deleted too; the ranks then go up line by line, and those of each length are looked at.

All of it is DataFrame operations; no step gathers the suffixes of a rank in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.spans import row_key
from rillflow.workspace import land

SOLID = r"[^\x20\x09-\x0D]"


def _lines(docs: DataFrame, counted: bool = False) -> DataFrame:
    """A row per line with a word: document, number among these lines, number among all, a 128-bit id, and the number of words if asked for."""
    numbered = F.transform(F.split("text", "\n", -1), lambda line, at: F.struct(at.alias("at"), line.alias("line")))
    solid = F.filter(numbered, lambda x: x["line"].rlike(SOLID))
    words = lambda x: [F.regexp_count(x["line"], F.lit(f"{SOLID}+")).alias("own")] if counted else []
    ids = F.transform(solid, lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit("line"), x["line"]).alias("b"), *words(x)))
    return docs.select("id", "mark", F.posexplode(ids).alias("seq", "x")).select("id", "mark", "seq", "x.*")


def _ranked(suffixes: DataFrame, *parts: str) -> DataFrame:
    """``(id, mark, seq, rank)`` of the suffixes whose ``parts`` are shared with another suffix."""
    shared = suffixes.groupBy(*parts).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    order = land(shared.orderBy(*parts).select(*parts, F.monotonically_increasing_id().alias("place")), "ranks")
    counts = [c for c in ("own", "words") if c in suffixes.columns]
    return land(suffixes.join(order, [*parts]).select("id", "mark", "seq", F.col("place").alias("rank"), *counts), "suffixes")


def _doubled(suffixes: DataFrame, step: int) -> DataFrame:
    """Pair each suffix with the rank of the one ``step`` lines on; without a shared one there the pair is unique, and goes."""
    on = Window.partitionBy("id", "mark").orderBy("seq").rangeBetween(step, step)
    pairs = suffixes.withColumn("then", F.first("rank").over(on))
    if "words" in suffixes.columns:
        pairs = pairs.withColumn("words", F.col("own") + F.first("words").over(on))
    return _ranked(pairs.where("then is not null"), "rank", "then")


def _later(suffixes: DataFrame) -> DataFrame:
    """The suffixes that are not the first of their rank."""
    firsts = suffixes.groupBy("rank").agg(F.min("id").alias("first"))
    own = Window.partitionBy("id", "mark", "rank")
    later = suffixes.withColumn("own_first", F.min("seq").over(own)).join(firsts, "rank")
    return later.where("seq > own_first or (first is not null and not (id <=> first))")


def repeated_runs(lines: DataFrame, min_lines: int, long_words: int | None = None) -> DataFrame:
    """``(id, mark, seq, length)`` of the suffixes whose first ``length`` lines also stand earlier.

    ``length`` is ``min_lines``, or less for runs of more than ``long_words`` words.
    """
    columns = ["id", "mark", "seq"]
    if long_words is not None:
        lines = lines.withColumn("words", F.col("own"))
    suffixes, length, found = _ranked(lines, "a", "b"), 1, []
    while length < min_lines:
        if long_words is not None:
            long = _later(suffixes).where(F.col("words") > long_words)
            found.append(long.select(*columns, F.lit(length).alias("length")))
        # A step of one line overlaps, and leaves no length out.
        step = min(length, min_lines - length) if long_words is None else 1
        suffixes, length = _doubled(suffixes, step), length + step
    found.append(_later(suffixes).select(*columns, F.lit(min_lines).alias("length")))
    return reduce(DataFrame.union, found).distinct()


def dedup_lines(docs: DataFrame, min_lines: int = 3, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None) -> DataFrame:
    """``(id, n_lines, removed, kept)``, a row per row of ``docs``: numbers of deleted lines, and the text left.

    A run of at least ``min_lines`` lines, or of more than ``long_words`` words if given, is deleted where it also stands in
    a document with a smaller id or earlier in its own document; copies may overlap. Lines without a word are not part of runs and stay. Rows that
    share an id are ties and keep each other's lines; a NULL id ranks last, and rows with a NULL id are ties. A NULL
    text has no lines and stays NULL. Other columns are ignored. An empty table gives no rows.
    """
    rows = _keyed(docs, id_col, text_col)
    marked = _removed(rows, min_lines, long_words)
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    joined = rows.join(marked, _same_row(rows), "left").select("id", "mark", "text", gone.alias("removed"))
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    out = joined.select("id", F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(lines).alias("n_lines"), "removed", _without("text", "removed").alias("kept"))
    return out.withColumnRenamed("id", id_col)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    identity, mark = row_key("id", "text")
    return rows.select(identity.alias("id"), mark.alias("mark"), "text")


def _removed(rows: DataFrame, min_lines: int, long_words: int | None = None) -> DataFrame:
    """``(of, marked, removed)``: the line numbers to delete, for documents that have any."""
    lines = land(_lines(rows, long_words is not None), "lines")
    runs = repeated_runs(lines, min_lines, long_words)
    covered = runs.select("id", "mark", F.explode(F.sequence(F.col("seq"), F.col("seq") + F.col("length") - 1)).alias("seq")).distinct()
    same = F.col("c.id").eqNullSafe(F.col("l.id")) & (F.col("c.mark") == F.col("l.mark")) & (F.col("c.seq") == F.col("l.seq"))
    places = covered.alias("c").join(lines.alias("l"), same).select("l.id", "l.mark", "l.at")
    return places.groupBy(F.col("id").alias("of"), F.col("mark").alias("marked")).agg(F.sort_array(F.collect_set("at")).alias("removed"))


def _same_row(rows: DataFrame) -> Column:
    return rows["id"].eqNullSafe(F.col("of")) & (rows["mark"] == F.col("marked"))


def _without(text: str, removed: str) -> Column:
    """The text without the numbered lines."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed))
    return F.when(F.size(removed) == 0, F.col(text)).otherwise(F.array_join(F.transform(kept, lambda at: lines[at]), "\n"))


def drop_repeated_lines(docs: DataFrame, min_lines: int = 3, id_col: str = "doc_id", text_col: str = "text", long_words: int | None = None) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text_col``; all rows and columns stay, whatever their names.

    Which lines go is said at ``dedup_lines``: NULL and empty texts stay as they are, equal rows and rows that share an id keep
    each other's lines, and an empty table gives no rows.
    """
    marked = _removed(_keyed(docs, id_col, text_col), min_lines, long_words)
    identity, mark = row_key(id_col, text_col)
    rows = docs.select(F.struct(*docs.columns).alias("own_row"), F.col(text_col).alias("own_text"), identity.alias("own_id"), mark.alias("own_mark"))
    joined = rows.join(marked, F.col("own_id").eqNullSafe(F.col("of")) & (F.col("own_mark") == F.col("marked")), "left")
    text = F.when(F.col("removed").isNull(), F.col("own_text")).otherwise(_without("own_text", "removed"))
    return joined.select(*(text.alias(c) if c == text_col else F.col(f"own_row.`{c}`") for c in docs.columns))
