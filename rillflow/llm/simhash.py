"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits, each the majority of that bit over the hashes of a text's shingles. Two
fingerprints link if they differ in at most ``radius`` bits. The tables come from a covering family:
bit ``i`` is given the non-zero vector ``m(i)`` of ``radius + 1`` bits, and every non-zero vector
``v`` makes one table, which looks at the bits with odd ``<m(i), v>``. The vectors of ``radius``
differing bits cannot span all ``radius + 1`` dimensions, so some ``v`` is orthogonal to all of them,
and its table sees no difference: no pair within the radius is missed. With ``parts`` > 1 the bits
are cut into blocks, of which at least one has ``radius // parts`` differences or fewer.

Within a bucket, links are found by a search that never looks at a linked fingerprint twice and that
returns a spanning forest instead of all pairs. Copies share a fingerprint and enter once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.graph import components
from rillflow.llm.spans import row_key
from rillflow.workspace import land

SEED = 42
# Buckets with more fingerprints are cut again by another covering family, up to this many times.
BUCKET_ROWS = 1 << 16
LEVELS = 3
# Buckets up to this size are compared by shifted arrays, all of a batch at once.
SMALL_BUCKET = 12
CHUNK = 1 << 15


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Fingerprint of one text as a signed 64-bit integer; zero if it has no words."""
    words = text.lower().split()  # of bytes: A-Z only, and split at \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle + 1, 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, last, CHUNK):
        spans = zip(starts[low : min(low + CHUNK, last)].tolist(), ends[low : low + CHUNK].tolist(), strict=False)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seeds: tuple[int, ...] = (SEED,), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp0, fp1, ...)``: one fingerprint per seed and row; a NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = [pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64()) for seed in seeds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = [id_col, *(f"fp{k}" for k in range(len(seeds)))]
    kept = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = kept.schema[0].dataType.simpleString()
    return kept.mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *(f"{name} long" for name in names[1:])]))


def masks(radius: int, parts: int = 1, level: int = 0) -> list[int]:
    """The bit masks of all tables, as unsigned 64-bit integers; another family for each level."""
    width, spread = 64 // parts, radius // parts
    vectors = (1 << spread + 1) - 1

    def family(step: int) -> list[int]:
        # Coprime steps deal the vectors out evenly, in another order for each level.
        dealt = [1 + (i * step + i // vectors * level) % vectors for i in range(width)]
        return [sum(((m & v).bit_count() & 1) << i for i, m in enumerate(dealt)) for v in range(1, vectors + 1)]

    # The families whose smallest mask has the most bits come first.
    steps = [s for s in range(1, vectors + 1) if math.gcd(s, vectors) == 1]
    best = sorted((family(s) for s in steps), key=lambda own: -min(mask.bit_count() for mask in own))
    return [mask << part * width for part in range(parts) for mask in best[level % len(best)]]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _buckets(rows: DataFrame, radius: int, parts: int, level: int, key: Column | None) -> DataFrame:
    """A row per fingerprint and table, sorted by bucket key within its partition.

    Keys are hashes of table and masked bits; should two buckets meet, their pairs are still compared.
    """
    own = [] if key is None else [key]
    keys = [F.xxhash64(*own, F.lit(t), F.col("fp0").bitwiseAND(F.lit(_signed(mask)))) for t, mask in enumerate(masks(radius, parts, level))]
    names = [c for c in rows.columns if c != "key"]
    exploded = rows.select(F.explode(F.array(*keys)).alias("key"), *names)
    return exploded.repartition("key").sortWithinPartitions("key")


def _spanning(prints: np.ndarray, radii: tuple[int, ...]) -> list[tuple[int, int]]:
    """Edges that connect what is linked within one bucket."""
    rest, edges, queue = np.arange(1, len(prints)), [], [0]
    while len(rest):
        if not queue:
            queue, rest = [int(rest[0])], rest[1:]
            continue
        at = queue.pop()
        near = np.ones(len(rest), bool)
        for k, radius in enumerate(radii):
            near &= np.bitwise_count(prints[rest, k] ^ prints[at, k]) <= radius
        found = rest[near].tolist()
        edges += [(at, other) for other in found]
        queue += found
        rest = rest[~near]
    return edges


def _link(batches: Iterator[pa.RecordBatch], radii: tuple[int, ...], bucket_rows: int | None) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of a sorted partition; fingerprints of too large a bucket go on unlinked (no ``v``)."""
    names = ["key", "node", *(f"fp{k}" for k in range(len(radii)))]
    held: np.ndarray | None = None  # rows of the bucket that may go on in the next batch
    over: int | None = None  # key of a bucket that is too large

    def out(u: np.ndarray, v: np.ndarray | None, rows: np.ndarray | None = None) -> pa.RecordBatch:
        n = len(u)
        other = pa.nulls(n, pa.int64()) if v is None else pa.array(v)
        rest = [pa.nulls(n, pa.int64()) for _ in radii] if rows is None else [pa.array(rows[:, 2 + k]) for k in range(len(radii))]
        own = pa.nulls(n, pa.int64()) if rows is None else pa.array(rows[:, 0])
        return pa.RecordBatch.from_arrays([pa.array(u), other, own, *rest], names=["u", "v", *("key", *names[2:])])

    def whole(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of complete buckets."""
        keys, nodes, prints = rows[:, 0], rows[:, 1], rows[:, 2:].view(np.uint64)
        heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(heads, len(keys)))
        small = np.repeat(sizes <= SMALL_BUCKET, sizes)
        us, vs = [], []
        for shift in range(1, min(SMALL_BUCKET, len(keys))):
            at = np.flatnonzero((keys[shift:] == keys[:-shift]) & small[shift:])
            if not len(at):
                break
            for k, radius in enumerate(radii):
                at = at[np.bitwise_count(prints[at, k] ^ prints[at + shift, k]) <= radius]
            us.append(nodes[at])
            vs.append(nodes[at + shift])
        for head, size in zip(heads[sizes > SMALL_BUCKET].tolist(), sizes[sizes > SMALL_BUCKET].tolist(), strict=True):
            edges = np.array(_spanning(prints[head : head + size], radii), dtype=np.int64).reshape(-1, 2) + head
            us.append(nodes[edges[:, 0]])
            vs.append(nodes[edges[:, 1]])
        if us:
            yield out(np.concatenate(us), np.concatenate(vs))

    for batch in batches:
        rows = np.column_stack([batch.column(name).to_numpy(zero_copy_only=False) for name in names])
        if over is not None:
            going = rows[:, 0] == over
            if going.any():
                yield out(rows[going, 1], None, rows[going])
                rows = rows[~going]
            if not len(rows):
                continue
            over = None
        if held is not None:
            rows = np.concatenate((held, rows))
        if not len(rows):
            continue
        cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
        if cut:
            yield from whole(rows[:cut])
        held = rows[cut:]
        if bucket_rows is not None and len(held) > bucket_rows:
            over = int(held[0, 0])
            yield out(held[:, 1], None, held)
            held = None
    if held is not None:
        yield from whole(held)


def links(prints: DataFrame, radii: tuple[int, ...], parts: int = 1, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(u, v)`` node pairs that connect all fingerprints within ``radii`` of each other.

    ``prints`` has one row per distinct fingerprint: ``node`` and ``fp0, fp1, ...``. The tables guarantee
    the first radius; further fingerprints must lie within theirs as well. A task holds at most
    ``bucket_rows`` fingerprints of one bucket; larger buckets are cut by another family.
    """
    names = ["key", *(f"fp{k}" for k in range(len(radii)))]
    schema = ", ".join(["u long", "v long", *(f"{name} long" for name in names)])
    found, rows, key = [], prints, None
    for level in range(LEVELS):
        limit = bucket_rows if level + 1 < LEVELS else None
        buckets = _buckets(rows, radii[0], parts, level, key)
        landed = land(buckets.mapInArrow(lambda it, n=limit: _link(it, radii, n), schema), "links")
        found.append(landed.where("v is not null").select("u", "v"))
        rows, key = landed.where("v is null").select(F.col("u").alias("node"), *names), F.col("key")
        if not rows.take(1):
            break
    return reduce(DataFrame.union, found).distinct()


def near_duplicates(
    docs: DataFrame,
    radius: int = 4,
    shingle: int = 4,
    parts: int = 1,
    confirm: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, fp0, ..., component_id)``, a row per row of ``docs``.

    Fingerprints within ``radius`` bits link, and ``component_id`` is the smallest id reachable over
    links. ``confirm`` asks for a second, independent fingerprint within so many bits too, which rules
    out chance links at a large radius. Texts without words have fingerprint zero and link like others;
    a NULL text counts as empty. Repeated rows and ids are kept. NULL ids are no smallest id: a
    component without any other has a NULL ``component_id``. Other columns are ignored. An empty table
    gives no rows.
    """
    seeds, radii = ((SEED,), (radius,)) if confirm is None else ((SEED, SEED + 1), (radius, confirm))
    names = [f"fp{k}" for k in range(len(seeds))]
    node = F.col("fp0") if confirm is None else F.xxhash64(*names)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("body"))
    prints = land(fingerprints(rows, shingle, seeds, "id", "body").withColumn("node", node), "fingerprints")
    return prints.join(_components_of(prints, names, radii, parts), "node").select(F.col("id").alias(id_col), *names, "component_id")


def _components_of(prints: DataFrame, names: list[str], radii: tuple[int, ...], parts: int) -> DataFrame:
    """``(node, component_id)``: the smallest id of the component of every fingerprint, for rows of ``(id, node, <names>)``."""
    distinct = prints.groupBy("node", *names).agg(F.min("id").alias("first"))
    roots = components(links(distinct.select("node", *names), radii, parts))
    labelled = distinct.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    return labelled.join(lowest, "root").select("node", "component_id")


def keep_one(docs: DataFrame, radius: int = 4, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component of ``near_duplicates`` the row with the smallest id stays.

    Of several rows with that id the one with the smallest MD5 of its text stays, and of rows equal in both any one. A NULL id is
    the largest, a NULL text counts as empty, and texts without words are near duplicates of each other. All columns
    are kept, whatever their names. An empty table gives no rows. Texts are moved at most once, beside the few numbers
    that tell which rows go.
    """
    identity, mark = row_key(id_col, text_col)
    place = F.struct(identity.isNull().alias("late"), identity.alias("id"), mark.alias("mark"))
    rows = docs.select(place.alias("place"), F.col(text_col).alias("body"))
    prints = land(fingerprints(rows, shingle, (SEED,), "place", "body").select(F.col("place").alias("id"), "fp0", F.col("fp0").alias("node")), "fingerprints")
    own = prints.join(_components_of(prints, ["fp0"], (radius,), 1), "node")
    # Rows that go, and places of which one of several equal rows stays.
    counted = own.groupBy("id", "component_id").agg(F.count(F.lit(1)).alias("n"))
    told = land(counted.where("id <> component_id or n > 1").select("id", (F.col("id") == F.col("component_id")).alias("first")), "copies")
    whole = docs.select(place.alias("place"), F.struct(*docs.columns).alias("row"))
    joined = whole.join(told.select(F.col("id").alias("told"), "first"), F.col("place") == F.col("told"), "left")
    single = joined.where("told is null").select("row.*")
    repeated = joined.where("first").dropDuplicates(["place"]).select("row.*")
    return single.union(repeated)
