"""Removing repeated lines, sentences or paragraphs by hash.

Units are normalised, their digests grouped over all documents, and the earliest occurrence in rank order
(document id, then offset) is kept. The others are cut out; their original byte offsets stay in the result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.spans import remove_spans, row_key
from rillflow.workspace import land

# What ends a unit of each kind; the end belongs to the unit.
KINDS = {
    "paragraph": re.compile(rb"\n[ \t\r]*\n\s*"),
    "line": re.compile(rb"\n"),
    "sentence": re.compile(rb"(?:[.!?]+(?=\s)|\n)\s*"),
}
_PUNCTUATION = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def normalise(unit: bytes) -> bytes:
    """ASCII letters in lower case, and single spaces for all other ASCII but digits."""
    return _PUNCTUATION.sub(b" ", unit.lower()).strip()


def units(text: bytes, kinds: tuple[str, ...], min_words: int) -> Iterator[tuple[bytes, int, int]]:
    """``(digest, start, end)`` of all units with at least ``min_words`` words, and of runs of shorter ones.

    A run begins at every shorter unit and takes in the shorter units that follow until it has ``min_words`` words, wherever it
    stands, so that no text is exempt because of its line breaks. Units without a word are passed over.
    """
    for kind in kinds:
        start, own = 0, []
        for end in [*(m.end() for m in KINDS[kind].finditer(text)), len(text)]:
            plain = normalise(text[start:end])
            if plain:
                own.append((plain, plain.count(b" ") + 1, start, end))
            start = end
        for k, (plain, n, start, end) in enumerate(own):
            if n >= min_words:
                yield hashlib.blake2b(plain, digest_size=16, person=kind.encode()).digest(), start, end
                continue
            run, last = [plain], k
            while n < min_words and last + 1 < len(own) and own[last + 1][1] < min_words:
                last += 1
                run.append(own[last][0])
                n += own[last][1]
            if n >= min_words:
                yield hashlib.blake2b(b" ".join(run), digest_size=16, person=kind.encode() + b"-run").digest(), start, own[last][3]


def dedup_units(
    docs: DataFrame, kinds: tuple[str, ...] = ("paragraph", "line", "sentence"), min_words: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, n_bytes, removed, kept)``, a row per row of ``docs``; ``removed`` holds the original byte spans.

    A unit is removed if an equal one (after lower-casing and dropping punctuation) stands in a document with a
    smaller id or earlier in its own. ``kinds`` may name lines, sentences and paragraphs, each compared with
    its own kind. Units of fewer than ``min_words`` words are compared as runs of ``min_words`` words or more, which may
    overlap; only those in too short a run always stay. Rows that share an id are ties and keep each
    other's units; a NULL id ranks last, and rows with a NULL id are ties. NULL texts are empty. Other columns
    are ignored. An empty table gives no rows.

    A document sends a digest once, and the smallest id per digest is combined before its shuffle, so frequent
    units cost little; the join back is on a side that run-time re-planning splits.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                seen: set[bytes] = set()
                found = []
                for digest, start, end in units(batch.column(2)[k].as_py() or b"", kinds, min_words):
                    found.append((digest, start, end, digest in seen))
                    seen.add(digest)
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.binary(), pa.int64(), pa.int64(), pa.bool_()), strict=True)]
                    same = [pa.repeat(batch.column(c)[k], len(found)) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*same, *columns], names=["id", "mark", "digest", "start", "end", "again"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    identity, mark = row_key("id", "text")
    rows = rows.select(identity.alias("id"), mark.alias("mark"), "text")
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(_rebatched(find), f"id {kind}, mark string, digest binary, start long, end long, again boolean")
    found = land(found, "units")
    # Equal rows have equal units; one copy of them is enough to know what goes.
    firsts = found.where(~F.col("again")).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = found.join(firsts.select("digest", "first"), "digest", "left").where("again or (first is not null and not (id <=> first))")
    spans = later.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    marked = spans.select(F.col("id").alias("of"), F.col("mark").alias("marked"), "spans")
    joined = rows.join(marked, F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("marked")), "left")
    return remove_spans(joined.select("id", "text", "spans")).withColumnRenamed("id", id_col)


def _rebatched(find, rows: int = 20_000):
    """Merge the small batches of single documents into larger ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in find(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= rows:
                yield pa.concat_batches(held)
                held, size = [], 0
        if held:
            yield pa.concat_batches(held)

    return run
