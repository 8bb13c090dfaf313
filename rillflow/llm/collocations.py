"""Collocations: phrases whose words stand together more often than their parts would make them.

Phrases are counted by a multikey three-way quicksort of suffix pointers, cut off at the longest phrase. Every word
opens a suffix of up to ``depth`` words within its piece.

1. Each task numbers the words of a slice of texts, adds up equal suffixes and sends them on in blocks, routed by
   a hash of their leading words: whole suffixes by two words, words alone by one.
2. A bucket is sorted word by word: three-way partitions around a pivot, of which the middle one shares a word
   more. Its weight is the count of that phrase. Partitions of any kind that weigh less than ``least`` hold no frequent phrase and
   are abandoned.
3. A bucket with too many different suffixes isn't sorted but goes on: its blocks are routed again by more of the hash, and
   in the last round by all words of every phrase length, where only equal phrases meet and are added up. So no task
   holds more than its share of a hot phrase.

Scores, containment and ranks are joins and windows over the frequent phrases alone.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.workspace import land

SLICE_BYTES = 8 << 20
# Different suffixes that a task sorts at once, and those of one block.
BUCKET_RUNS = 1 << 21
BLOCK_RUNS = 512
# Buckets of one round of routing: more would make tiny blocks. Texts of this size fill a bucket by half.
FANOUT = 4096
BUCKET_BYTES = 6 << 20
ROUTED_ROUNDS = 2

# Marks between pieces. In ``PLAIN`` all of them become a full stop, and tabs spaces.
MARKS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(bytes(range(65, 91)) + MARKS + b"\t", bytes(range(97, 123)) + b"." * len(MARKS) + b" ")
BREAK = re.compile(rb"[ .]")

BLOCKS = "lang string, lo int, hi int, bucket long, n long, runs binary, counts binary"
FOUND = f"{BLOCKS}, words int, phrase string"
NAMES = [column.split()[0] for column in FOUND.split(", ")]


def parts(data: bytes, limit: int, ahead: int) -> Iterator[tuple[bytes, int]]:
    """A text in parts of about ``limit`` bytes, each with up to ``ahead`` words of the next part if their piece goes on.

    The number of these words comes with the part. Nothing is cut within a word.
    """
    following = re.compile(rb"(?: +[^ .]+){0,%d}" % ahead)
    start = 0
    while len(data) - start > limit:
        cut = max(data.rfind(mark, start + 1, start + limit) for mark in (b".", b" "))
        if cut < 0:
            found = BREAK.search(data, start + limit)
            if not found:
                break
            cut = found.start()
        more = following.match(data, cut)[0]
        yield data[start:cut] + more, len(more.split())
        start = cut
    yield data[start:], 0


class Suffixes:
    """Weighted suffixes over numbered words; number 0 is the end of a piece."""

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.table: defaultdict[bytes, int] = defaultdict()
        self.table.default_factory = self.table.__len__
        self.table[b"."]
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add_words(self, part: bytes, extra: int) -> None:
        """All suffixes of a part but those that the last ``extra`` words open."""
        tokens = part.replace(b".", b" . ").split()
        ids = np.zeros(len(tokens) + self.depth, np.int32)
        ids[: len(tokens)] = np.fromiter(map(self.table.__getitem__, tokens), np.int32, len(tokens))
        opens = np.flatnonzero(ids[: len(tokens) - extra])
        runs = np.zeros((len(opens), self.depth), np.int32)
        going = np.ones(len(opens), bool)
        for k in range(self.depth):
            going &= ids[opens + k] > 0
            runs[going, k] = ids[opens + k][going]
        self.add(runs, np.ones(len(opens), np.int64))

    def add_block(self, runs: bytes, counts: bytes) -> None:
        """A block that another task has sent."""
        tokens = runs.split(b"\n")[:-1]
        ids = np.fromiter(map(self.table.__getitem__, tokens), np.int32, len(tokens))
        self.add(ids.reshape(-1, self.depth), np.frombuffer(counts, np.int64))

    def add(self, runs: np.ndarray, counts: np.ndarray) -> None:
        self.held.append((runs, counts))
        self.size += len(runs)

    def combine(self) -> tuple[np.ndarray, np.ndarray]:
        """Different suffixes with their weights."""
        runs = np.concatenate([r for r, _ in self.held]) if self.held else np.zeros((0, self.depth), np.int32)
        counts = np.concatenate([c for _, c in self.held]) if self.held else np.zeros(0, np.int64)
        runs, counts = added(runs, counts, len(self.table))
        self.held, self.size = [(runs, counts)], len(runs)
        return runs, counts

    def words(self) -> list[bytes]:
        return list(self.table)


def added(runs: np.ndarray, counts: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal runs added up."""
    key, bound = np.zeros(len(runs), np.int64), 1
    for column in runs.T:
        if bound * n_words >= 1 << 62:
            key, bound = np.unique(key, return_inverse=True)[1].reshape(-1), len(runs)
        key, bound = key * n_words + column, bound * n_words
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.diff(key[order], prepend=-1))
    if not len(heads):
        return runs, counts
    return runs[order[heads]], np.add.reduceat(counts[order], heads)


def frequent(runs: np.ndarray, counts: np.ndarray, lo: int, hi: int, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, one run of each, weight)`` of the phrases of ``lo`` to ``hi`` words that weigh ``least`` or more.

    The multikey quicksort, with all partitions of a depth cut in the same step. ``at`` are the pointers; ``starts``
    opens the partitions.
    """
    at, starts = np.arange(len(runs)), np.zeros(min(len(runs), 1), np.int64)
    for depth in range(hi):
        column, done = runs[:, depth], []
        while len(at):
            sizes = np.diff(np.append(starts, len(at)))
            part = np.repeat(np.arange(len(starts)), sizes)
            own = column[at]
            pivot = own[starts + sizes // 2]
            side = 1 + np.sign(own - pivot[part])
            slot = 3 * part + side
            at = at[np.argsort(slot, kind="stable")]
            sizes = np.bincount(slot, minlength=3 * len(starts))
            starts = np.cumsum(sizes) - sizes
            total = np.append(0, np.cumsum(counts[at]))
            weights = total[starts + sizes] - total[starts]
            middle = np.arange(len(sizes)) % 3 == 1
            heavy = (weights >= least) & (sizes > 0)
            # The end of a piece is no word.
            ready = heavy & middle
            ready[ready] = column[at[starts[ready]]] > 0
            done.append((_taken(at, starts, sizes, ready), sizes[ready], weights[ready]))
            rest = heavy & ~middle
            at, sizes = _taken(at, starts, sizes, rest), sizes[rest]
            starts = np.cumsum(sizes) - sizes
        if not done:
            return
        at, sizes, weights = (np.concatenate(x) for x in zip(*done, strict=True))
        starts = np.cumsum(sizes) - sizes
        if depth + 1 >= lo and len(at):
            yield depth + 1, at[starts], weights


def _taken(at: np.ndarray, starts: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The pointers of the chosen partitions."""
    return at[np.repeat(chosen, sizes)]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def _route(hashes: np.ndarray, runs: np.ndarray, lo: int, divisor: int, buckets: int) -> np.ndarray:
    """Bucket of every run by its first ``lo`` words."""
    mixed = np.zeros(len(runs), np.uint64)
    for column in runs.T[:lo]:
        mixed = (mixed ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed // np.uint64(divisor) % np.uint64(buckets)).astype(np.int64)


def _blocks(lang: str, lo: int, hi: int, bucket: np.ndarray, runs: np.ndarray, counts: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
    """Runs as rows of up to ``BLOCK_RUNS`` of one bucket."""
    order = np.argsort(bucket, kind="stable")
    bucket, runs, counts = bucket[order], runs[order], np.ascontiguousarray(counts[order])
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    sizes = np.diff(np.append(heads, len(bucket)))
    cuts = -(-sizes // BLOCK_RUNS)
    nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    starts = np.repeat(heads, cuts) + nth * BLOCK_RUNS
    ends = np.append(starts[1:], len(bucket))
    lines = pa.array([w + b"\n" for w in words], pa.large_binary()).take(pa.array(runs.ravel()))
    places = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1)
    at = np.append(starts, len(bucket)) * runs.shape[1]
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places[at].tobytes()), lines.buffers()[2]])
    offsets = pa.py_buffer((np.append(starts, len(bucket)) * 8).tobytes())
    numbers = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(counts.tobytes())])
    n = len(starts)
    total = np.append(0, np.cumsum(counts))
    columns = [pa.array([lang] * n, pa.string()), pa.array(np.full(n, lo, np.int32)), pa.array(np.full(n, hi, np.int32)), pa.array(bucket[starts])]
    return pa.RecordBatch.from_arrays([*columns, pa.array(total[ends] - total[starts]), text.cast(pa.binary()), numbers.cast(pa.binary())], names=NAMES[:7])


def _routed(lang: str, own: Suffixes, kind: tuple[int, int], divisor: int, buckets: int, split: bool) -> Iterator[pa.RecordBatch]:
    """Blocks of what is held, routed by its leading words; ``split`` cuts it into phrases of every length first."""
    runs, counts = own.combine()
    words = own.words()
    hashes = _hashes(words)
    lengths = [kind] if not split else [(k, k) for k in range(kind[0], kind[1] + 1)]
    for lo, hi in lengths:
        some = runs[:, lo - 1] > 0
        cut, weights = runs[some], counts[some]
        if hi < own.depth:
            short, weights = added(cut[:, :hi], weights, len(words))
            cut = np.zeros((len(short), own.depth), np.int32)
            cut[:, :hi] = short
        if len(cut):
            yield _blocks(lang, lo, hi, _route(hashes, cut, lo, divisor, buckets), cut, weights, words)


def _text_blocks(batches: Iterator[pa.RecordBatch], depth: int, buckets: int, slice_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the words and of the suffixes of texts."""
    held: dict[str, Suffixes] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, own in held.items():
            for kind in ((1, 1), (2, depth)):
                yield from _routed(lang, own, kind, 1, buckets, False)
        held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for k, lang in enumerate(langs):
            text = batch.column(1)[k]
            data = text.as_buffer().to_pybytes().translate(PLAIN) if text.is_valid else b""
            for part, extra in parts(data, slice_bytes, depth - 1):
                if lang not in held:
                    held[lang] = Suffixes(depth)
                held[lang].add_words(part, extra)
                size += len(part)
                if size >= slice_bytes:
                    yield from flush()
                    size = 0
    yield from flush()


def _split_blocks(batches: Iterator[pa.RecordBatch], depth: int, divisor: int, buckets: int, last: bool, limit: int) -> Iterator[pa.RecordBatch]:
    """Blocks of buckets that were too large, routed again."""
    held: dict[tuple[str, int, int], Suffixes] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, lo, hi), own in held.items():
            yield from _routed(lang, own, (lo, hi), divisor, buckets, last)
        held.clear()

    for batch in batches:
        rows = [batch.column(name).to_pylist() for name in ("lang", "lo", "hi", "runs", "counts")]
        for lang, lo, hi, runs, counts in zip(*rows, strict=True):
            key = (lang, lo, hi)
            if key not in held:
                held[key] = Suffixes(depth)
            held[key].add_block(runs, counts)
            size += len(counts) // 8
            if size >= limit:
                yield from flush()
                size = 0
    yield from flush()


def _found(lang: str, length: int, phrases: list[str | None], totals: np.ndarray) -> pa.RecordBatch:
    n = len(phrases)
    empty = [pa.nulls(n, kind) for kind in (pa.int32(), pa.int32(), pa.int64())]
    blobs = [pa.nulls(n, pa.binary()) for _ in range(2)]
    columns = [pa.array([lang] * n, pa.string()), *empty, pa.array(totals.astype(np.int64)), *blobs, pa.array(np.full(n, length, np.int32)), pa.array(phrases, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def _count_blocks(batches: Iterator[pa.RecordBatch], depth: int, least: int, limit: int | None) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of the buckets of a sorted partition, and the number of words (length 0) per bucket of words.

    The blocks of a bucket with more than ``limit`` different runs come out again.
    """
    key, own, over = None, None, False

    def finish() -> Iterator[pa.RecordBatch]:
        if own is None or over:
            return
        lang, lo, hi, _ = key
        runs, counts = own.combine()
        words = own.words()
        if lo == 1:
            yield _found(lang, 0, [None], counts.sum(keepdims=True))
        for length, first, totals in frequent(runs, counts, lo, hi, least):
            yield _found(lang, length, [b" ".join([words[w] for w in run]).decode() for run in runs[first, :length].tolist()], totals)

    def handed(rows: pa.RecordBatch) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names=NAMES)

    for batch in batches:
        keys = list(zip(*(batch.column(name).to_pylist() for name in ("lang", "lo", "hi", "bucket")), strict=True))
        for k, other in enumerate(keys):
            if other != key:
                yield from finish()
                key, own, over = other, Suffixes(depth), False
            if over:
                yield handed(batch.slice(k, 1))
                continue
            own.add_block(batch.column("runs")[k].as_py(), batch.column("counts")[k].as_py())
            if limit is not None and own.size > limit:
                runs, counts = own.combine()
                over = 2 * len(runs) > limit
                if over:
                    lang, lo, hi, bucket = key
                    yield handed(_blocks(lang, lo, hi, np.full(len(runs), bucket), runs, counts, own.words()))
                    own = None
            elif limit is None and own.size > 2 * BUCKET_RUNS and own.size > 2 * len(own.held[0][0]):
                own.combine()
    yield from finish()


def phrase_counts(
    docs: DataFrame,
    depth: int = 3,
    least: int = 10,
    lang_col: str = "lang",
    text_col: str = "text",
    bucket_runs: int = BUCKET_RUNS,
    slice_bytes: int = SLICE_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``(lang, words, phrase, n)``: all phrases of one to ``depth`` words that occur ``least`` times or more in their language.

    The row with ``words`` 0 and no phrase has the number of all words of the language, however few. A task sorts about
    ``bucket_runs`` different suffixes at once.
    """
    if depth < 2:
        raise ValueError("phrases need two words or more")
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(FANOUT, max(1, math.ceil(size / bucket_bytes)))
    blocks = rows.mapInArrow(lambda it, b=buckets: _text_blocks(it, depth, b, slice_bytes), BLOCKS)
    divisor, found = 1, []
    for level in range(ROUTED_ROUNDS + 1):
        limit = bucket_runs if level < ROUTED_ROUNDS else None
        # As many partitions as heavy buckets, so that few of them meet in one task.
        tasks = max(2 * buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        dealt = blocks.repartition(tasks, "lang", "lo", "hi", "bucket").sortWithinPartitions("lang", "lo", "hi", "bucket")
        landed = land(dealt.mapInArrow(lambda it, n=limit: _count_blocks(it, depth, least, n), FOUND), "phrases")
        found.append(landed.where("runs is null").select("lang", "words", "phrase", "n"))
        rest = landed.where("runs is not null")
        left = rest.agg(F.sum(F.octet_length("counts") / 8)).first()[0]
        if not left:
            break
        divisor *= buckets
        last = level + 1 == ROUTED_ROUNDS
        buckets = math.ceil(2 * left / bucket_runs)
        buckets = max(2, buckets if last else min(FANOUT, buckets))
        if last:
            divisor = 1
        blocks = rest.select(*NAMES[:7]).mapInArrow(lambda it, d=divisor, b=buckets, s=last: _split_blocks(it, depth, d, b, s, bucket_runs), BLOCKS)
    together = reduce(DataFrame.union, found)
    totals = together.where("words = 0").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return together.where("words > 0").union(totals)


def collocations(
    docs: DataFrame,
    depth: int = 3,
    least: int = 10,
    top: int = 2000,
    inside_percent: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
    **sizes: int,
) -> DataFrame:
    """``(lang, rank, phrase, words, a, l, r, n, score)``: the best ``top`` phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs. A
    phrase has two to ``depth`` words within a piece and ``a`` >= ``least`` occurrences, overlaps included. Cut in two, its parts occur
    ``l`` and ``r`` times; the cut with the lowest score ``floor(1000000 a a / (l r))`` counts, of equal ones the first. A phrase goes
    if one longer candidate that holds it occurs at least ``inside_percent`` of 100 as often. ``n`` is the number of words of the language.
    Ties in score fall to the more frequent phrase, then to the first in byte order. A NULL language is ``und``, a NULL or empty text
    has no words, copies of rows count as often as they occur, other columns are ignored, and an empty table gives no rows.
    """
    known = land(phrase_counts(docs, depth, least, lang_col, text_col, **sizes), "frequent-phrases")
    phrases = known.where("words > 0")
    found = phrases.where("words > 1").withColumnRenamed("n", "a")
    cuts = found.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
    cuts = cuts.withColumn("first", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - words)"))
    left = phrases.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # Products of two counts pass 64 bits; the quotient is at most a million, as no part is rarer than the phrase.
    score = F.expr("(1000000bd * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    pieces = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m), i -> "
        "substring_index(substring_index(phrase, ' ', i + m), ' ', -m))))"
    )
    inner = found.where("words > 2").select("lang", F.explode(pieces).alias("phrase"), F.col("a").alias("longer"))
    longest = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(longest, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {int(inside_percent)} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = known.where("words = 0").select("lang", "n")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "words", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score")
    )
