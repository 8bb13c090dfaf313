"""Benchmark items contained in documents: size-partitioned MinHash containment search, then an exact check.

Containment is the share of an item's word shingles that a document has. An item's sketch is its lowest
``SKETCH`` shingle hashes; items up to that size are a partition of their own, whose sketches are complete.
A document of any length is looked through with all its shingles: those in some sketch are counted by item,
and a pair goes on if it has enough of them for the item's partition. No document much smaller than an item
can contain it, so its size prunes as well. Pairs that go on are checked on the shingles themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.spans import row_key
from rillflow.workspace import land

SKETCH = 24
SHINGLE = 5
# Most hits that chance may take from the expected number, in standard deviations.
SLACK = 6
# Hash prefixes of the sketches in a table of so many bits, which every task gets: half a MB however many items there are.
FILTER_BITS = 22
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_MEMO = 400_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, in lower case."""
    return WORD.findall((text or "").lower().encode())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of word shingles; the hashes of words are remembered."""

    def __init__(self, size: int) -> None:
        self.size, self.memo = size, {}

    def hashes(self, text: str | None, short: tuple[int, ...] = ()) -> np.ndarray:
        """Distinct hashes, sorted. Fewer words than a shingle are one shingle; no words give none.

        Those of runs of ``short`` numbers of words, below that of a shingle, are added on request.
        """
        found, memo = words(text), self.memo
        if len(memo) > _MEMO:
            memo.clear()
        out = []
        for w in found:
            h = memo.get(w)
            if h is None:
                h = memo[w] = xxhash.xxh64_intdigest(w)
            out.append(h)
        x = np.array(out, np.uint64)
        if not len(x):
            return x
        own = {min(self.size, len(x)), *(k for k in short if k <= len(x))}
        return np.unique(np.concatenate([self._runs(x, k) for k in sorted(own)]))

    @staticmethod
    def _runs(x: np.ndarray, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` words, given those of the words."""
        n = len(x) - size + 1
        mixed = np.full(n, size, np.uint64)
        for k in range(size):
            mixed = _mix(mixed * _MULTIPLIER + x[k : k + n])
        return mixed


def shingles(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves."""
    found = words(text)
    return _windows(found, min(size, len(found))) if found else set()


def _windows(found: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def needed(total: int, threshold: float) -> int:
    """Hits from which a pair goes on: exact for complete sketches, else what chance leaves with ``SLACK`` deviations."""
    if total <= SKETCH:
        return max(int(np.ceil(threshold * total - 1e-9)), 1)
    return max(int(SKETCH * threshold - SLACK * np.sqrt(SKETCH * threshold * (1 - threshold))), 1)


def _item_sketches(items: DataFrame, size: int, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(size)
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                found = hasher.hashes(batch.column(2)[k].as_py())
                need = needed(len(found), threshold)
                rows += [(k, h, len(found), need) for h in found[:SKETCH].view(np.int64).tolist()]
            at, hashes, totals, needs = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else ([], [], [], [])))
            same = [batch.column(c).take(pa.array(at)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(hashes), pa.array(totals), pa.array(needs)], names=["item", "item_mark", "h", "total", "need"])

    return items.mapInArrow(run, f"item {items.schema['item'].dataType.simpleString()}, item_mark string, h long, total long, need long")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, mark, item, n_item_shingles, n_shared, containment)`` for every document that holds an item.

    A pair is returned if at least ``threshold`` of the item's distinct shingles occur in the document. An item
    of fewer words than a shingle is one shingle of its own length, and is found wherever these words follow each other; leave out
    items that are ordinary words. NULL and empty items and documents match nothing. ``mark`` is the digest of the document's text: documents that share an id are
    looked at one by one, and rows equal in id and text give one pair, as do such items. NULL ids are kept. Other
    columns are ignored. Empty tables give no rows.

    Every item with up to 24 shingles is found for certain; a larger one at the threshold is missed with a
    probability below 1e-7. Documents send only shingles that pass a bit table of the sketches, so what is
    shuffled does not depend on the length of the texts but on what they share with items.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    identity, mark = row_key("id", "text")
    rows = rows.select(identity.alias("id"), mark.alias("mark"), "text")
    things = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("item_text"))
    identity, mark = row_key("item", "item_text")
    things = things.select(identity.alias("item"), mark.alias("item_mark"), "item_text").dropDuplicates(["item", "item_mark"])
    sketches = land(_item_sketches(things, shingle, threshold), "sketches")
    prefixes = sketches.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("p")).distinct().collect()  # 2^22 at most
    lengths = F.size(F.filter(F.split(F.lower("item_text"), "[^0-9a-z\\u0080-\\x{10FFFF}]+"), lambda w: w != ""))
    short = tuple(sorted(r.n for r in things.select(lengths.alias("n")).where(f"n > 0 and n < {int(shingle)}").distinct().collect()))  # fewer than a shingle has words
    table = np.zeros(1 << FILTER_BITS, bool)
    table[[r.p for r in prefixes]] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(table).tobytes())
    kind = rows.schema["id"].dataType.simpleString()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = Hasher(shingle), np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            at, hashes, sizes = [], [], []
            for k, text in enumerate(batch.column(2)):
                found = hasher.hashes(text.as_py(), short)
                hits = found[bits[(found >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]]
                at.append(np.full(len(hits), k))
                hashes.append(hits)
                sizes.append(np.full(len(hits), len(found)))
            where = pa.array(np.concatenate(at).astype(np.int64))
            same = [batch.column(c).take(where) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(np.concatenate(hashes).view(np.int64)), pa.array(np.concatenate(sizes).astype(np.int64))], names=["id", "mark", "h", "size"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, own = [], None, {}
            for k in range(batch.num_rows):
                text, item = batch.column(2)[k].as_py(), shingles(batch.column(4)[k].as_py(), shingle)
                if text != last:
                    last, own = text, {}
                size = len(next(iter(item)))
                if size not in own:
                    own[size] = _windows(words(text), size)
                out.append((len(item), len(item & own[size])))
            totals, both = (pa.array(c, pa.int64()) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (0, 1, 3)), totals, both], names=["id", "mark", "item", "n_item_shingles", "n_shared"])

    hits = rows.mapInArrow(probe, f"id {kind}, mark string, h long, size long").distinct()
    found = hits.join(sketches, "h").where(F.col("size") >= F.ceil(F.col("total") * threshold - 1e-9))
    pairs = found.groupBy("id", "mark", "item", "item_mark").agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need")).where("n >= need")
    pairs = land(pairs.select("id", "mark", "item", "item_mark"), "candidates")
    with_items = pairs.join(things, pairs["item"].eqNullSafe(things["item"]) & (pairs["item_mark"] == things["item_mark"])).select(pairs["id"].alias("of"), pairs["mark"].alias("marked"), pairs["item"], "item_text")
    both = rows.join(with_items, F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("marked")))
    kinds = f"id {kind}, mark string, item {things.schema['item'].dataType.simpleString()}, n_item_shingles long, n_shared long"
    checked = both.select("id", "mark", "text", "item", "item_text").mapInArrow(verify, kinds)
    good = checked.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles")).where(F.col("containment") >= threshold)
    return good.distinct().withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, whatever their names.

    Rows with NULL or empty texts hold none and stay; of rows that share an id each is judged by its own text, equal rows
    stay or go together. An empty table gives no rows, and without items all rows stay.
    """
    found = contained_items(docs, items, id_col=id_col, text_col=text_col, **options)
    dirty = found.select(F.col(id_col).alias("dirty_id"), F.col("mark").alias("dirty_mark")).distinct()
    identity, mark = row_key(id_col, text_col)
    rows = docs.select(F.struct(*docs.columns).alias("own_row"), identity.alias("own_id"), mark.alias("own_mark"))
    clean = rows.join(dirty, F.col("own_id").eqNullSafe(F.col("dirty_id")) & (F.col("own_mark") == F.col("dirty_mark")), "left_anti")
    return clean.select("own_row.*")
