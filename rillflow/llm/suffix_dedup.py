"""Removing long strings that also stand earlier, by a distributed merge sort of suffixes.

Every string of ``length`` bytes is represented by one suffix: the one that starts at its anchor, the leftmost
``GRAM``-byte gram with the lowest hash in the string. Equal strings have equal anchors, so only suffixes that
start at anchors are sorted, a small share of all. Each carries its next ``length`` bytes, the bytes before it
that its strings may reach, and the range of strings it stands for.

1. Anchor grams are counted over all documents. A bit table of the repeated ones goes to all tasks; it has
   eight bits for each of them, up to a fixed size, and what passes by chance only costs work.
2. Each task sorts the suffixes with repeated grams, those of several slices at once, and sends them on as front-coded
   runs: a common prefix length and the rest of each suffix. Suffixes equal in all they carry are sent once.
3. The runs of a part, which the lower half of the gram's hash gives, are merged by a loser tree that compares suffixes
   only beyond the prefix they are known to share, and that yields the common prefix length of neighbours. Prefix
   classes to the right and to the left of the anchors then tell which strings stand earlier, for all lengths of overlap.
4. The union of the repeated strings is cut out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillflow.llm.spans import remove_spans
from rillflow.workspace import land
LENGTH = 100
GRAM = 24
SLICE_BYTES = 1 << 20
# Suffixes that a task sorts together: the more, the longer its runs, and long ones take less room. They are some 12 MB.
POOL_ROWS = 1 << 16
# The bit table of repeated grams: 16 MB to 128 MB, collected in chunks.
FILTER_BITS = 27
MOST_FILTER_BITS = 30
CHUNK_BITS = 17
CODEC = "zstd"
# Suffixes of a part, which one task holds: some 60 MB.
PART_ROWS = 100_000
# Grams with fewer places than this are never spread: they are some 60 MB in a task.
HOT_ROWS = 100_000
NO_ID = np.iinfo(np.int64).max

_ODD = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(24).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Anchors of slices of text."""

    def __init__(self, length: int, gram: int) -> None:
        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.up = self.down = self.sums = np.zeros(0, np.uint64)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        """Hash of the gram at every position."""
        if len(self.up) < len(data) + 1:
            self.up, self.down = _powers(_ODD, len(data) + 1), _powers(pow(_ODD, -1, 1 << 64), len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.down[: len(data)], out=self.sums[1:])
        return self.spread((self.sums[self.gram :] - self.sums[: -self.gram]) * self.up[: len(data) - self.gram + 1])

    def string_hashes(self, starts: np.ndarray) -> np.ndarray:
        """Hashes of whole strings of the data looked at last."""
        return self.spread((self.sums[starts + self.length] - self.sums[starts]) * self.up[starts])

    @staticmethod
    def spread(h: np.ndarray) -> np.ndarray:
        h = h ^ (h >> np.uint64(32))
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def find(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(place, hash, first, last)``: anchors, and the first and last start of the strings each stands for.

        ``data`` holds documents one after another, which end at ``ends``. Strings do not cross documents.
        """
        none = np.zeros(0, np.int64)
        n = len(data) - self.length + 1
        if n < 1:
            return none, none.view(np.uint64), none, none
        h = self.hashes(data)
        bits = max(len(h).bit_length(), 1)
        keyed = (h >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(h), dtype=np.uint64)
        lowest, span = keyed, 1
        while span * 2 <= self.width:
            lowest, span = np.minimum(lowest[:-span], lowest[span:]), span * 2
        if span < self.width:
            lowest = np.minimum(lowest[: n], lowest[self.width - span : self.width - span + n])
        place = (lowest[:n] & np.uint64((1 << bits) - 1)).astype(np.int64)
        inside = np.ones(n, bool)
        for end in ends.tolist():
            inside[max(end - self.length + 1, 0) : end] = False
        starts = np.flatnonzero(inside)
        if not len(starts):
            return none, none.view(np.uint64), none, none
        at = place[starts]
        heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        tails = np.append(heads[1:], len(at)) - 1
        return at[heads], h[at[heads]], starts[heads], starts[tails]


def _slices(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, offsets, data, ends)`` of about ``SLICE_BYTES``.

    A longer text is cut into pieces that overlap by all but one byte of a string, so every string is in one piece.
    """
    rows, offsets, parts, size = [], [], [], 0

    def done():
        return np.array(rows), np.array(offsets), np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])

    for k, text in enumerate(batch.column(2)):
        text = memoryview(text.as_buffer() or b"")
        for at in range(0, max(len(text) - length + 1, 0), SLICE_BYTES):
            piece = text[at : at + SLICE_BYTES + length - 1]
            if rows and size + len(piece) > SLICE_BYTES:
                yield done()
                rows, offsets, parts, size = [], [], [], 0
            rows.append(k)
            offsets.append(at)
            parts.append(piece)
            size += len(piece)
    if rows:
        yield done()


def _gathered(data: np.ndarray, starts: np.ndarray, width: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Byte rows ``data[start : start + width]``, zero outside ``[low, high)``."""
    around = np.concatenate((np.zeros(width, np.uint8), data, np.zeros(width, np.uint8)))
    rows = np.lib.stride_tricks.sliding_window_view(around, width)[starts + width]
    column = np.arange(width, dtype=np.int16)
    rows[column < np.clip(low - starts, 0, width).astype(np.int16)[:, None]] = 0
    rows[column >= np.clip(high - starts, 0, width).astype(np.int16)[:, None]] = 0
    return rows


def _neighbours(rows: np.ndarray) -> np.ndarray:
    """Common prefix length of each row with the one before; zero for the first."""
    common = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return common


def front_code(rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Common prefix lengths of sorted rows, and the rests of the rows."""
    common = _neighbours(rows)
    rest = np.arange(rows.shape[1])[None, :] >= common[:, None]
    return common.astype(np.uint8), rows[rest].tobytes()


def front_decode(common: np.ndarray, rests: bytes, width: int) -> list[bytes]:
    out, last, at = [], b"", 0
    for c in common.tolist():
        size = width - c
        last = last[:c] + rests[at : at + size]
        out.append(last)
        at += size
    return out


def packed_bytes(data: bytes) -> bytes:
    return pa.compress(data, CODEC, asbytes=True)


def packed_longs(rows: np.ndarray) -> bytes:
    """Rows of numbers, packed by column and by byte of the number: high bytes are mostly alike."""
    return packed_bytes(np.ascontiguousarray(rows.astype("<i8").T).view(np.uint8).reshape(rows.shape[1], -1, 8).transpose(0, 2, 1).tobytes())


def unpacked_longs(data: bytes, n: int, columns: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n * columns, CODEC, asbytes=True), np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8").reshape(columns, n).T


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Common prefix length of two strings of one length that share ``known`` bytes."""
    x = int.from_bytes(a[known:], "big") ^ int.from_bytes(b[known:], "big")
    return len(a) - (x.bit_length() + 7) // 8


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """``(run, index, common)`` in sorted order, ``common`` being the prefix shared with the one before.

    ``runs`` are ``(strings, common prefix lengths within the run)``. A node of the tree holds the loser of its
    match and the prefix it shares with the last winner. Of two strings with different such prefixes the
    one with the longer is smaller; only equal ones are compared, beyond that prefix.
    """
    k = 1
    while k < len(runs):
        k *= 2
    place = [0] * k
    current = [runs[r][0][0] if r < len(runs) and runs[r][0] else None for r in range(k)]
    shared = [0] * k  # with the last winner
    tree = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
        x, y = current[a], current[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        p, q = shared[a], shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        c = common_prefix(x, y, p)
        if c == len(x) or x[c] < y[c]:
            shared[b] = c
            return a, b
        shared[a] = c
        return b, a

    level = list(range(k))
    node = k
    while len(level) > 1:
        node //= 2
        nxt = []
        for i in range(0, len(level), 2):
            win, tree[node + i // 2] = play(level[i], level[i + 1])
            nxt.append(win)
        level = nxt
    best = level[0]
    while current[best] is not None:
        yield best, place[best], shared[best]
        strings, commons = runs[best]
        place[best] += 1
        if place[best] < len(strings):
            current[best], shared[best] = strings[place[best]], commons[place[best]]
        else:
            current[best] = None
        at = (best + k) // 2
        while at:
            best, tree[at] = play(best, tree[at])
            at //= 2


def repeated_strings(
    right: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray, marks: np.ndarray, places: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the smallest and largest distance to the start of a string it stands for that stands earlier.

    ``right`` are common prefix lengths of sorted neighbours, ``left`` the bytes before the anchors, the nearest first,
    ``low`` and ``high`` the distances from a string's start to the anchor. Without an earlier one the smallest is
    ``length``. Earlier is a smaller id, or an earlier place in the same document.
    """
    n = len(right)
    least, most = np.full(n, length), np.full(n, -1)
    width = left.shape[1] + (-left.shape[1]) % 8
    padded = np.zeros((n, width), np.uint8)
    padded[:, : left.shape[1]] = left
    left_order = np.lexsort(padded.view(">u8").T[::-1])
    left_common = _neighbours(left[left_order])
    rank = np.lexsort((places, marks, ids))
    for o in range(int(low.min()), int(high.max()) + 1):
        classes = np.cumsum(right < length - o)
        left_class = np.empty(n, np.int64)
        left_class[left_order] = np.cumsum(left_common < o)
        own = rank[(low[rank] <= o) & (o <= high[rank])]
        key = classes[own] * (n + 1) + left_class[own]
        order = np.argsort(key, kind="stable")
        own, key = own[order], key[order]
        new = np.ones(len(own), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(own) else own
        later = ids[own] > ids[own[first]]
        # Within one document a later place counts; rows equal in all are ties.
        fresh = new.copy()
        fresh[1:] |= (ids[own[1:]] != ids[own[:-1]]) | (marks[own[1:]] != marks[own[:-1]])
        later |= places[own] > places[own[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]]
        hit = own[later]
        least[hit] = np.minimum(least[hit], o)
        most[hit] = np.maximum(most[hit], o)
    return least, most


def parts_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash, by its lower half: the hashes of anchors are the lowest of many, so the upper half is low for most."""
    return (h & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)


def parts_for(suffixes: int, tasks: int) -> int:
    """Parts of at most ``PART_ROWS`` suffixes, as many for each task."""
    return tasks * max(-(-suffixes // (tasks * PART_ROWS)), 1)


def table_bits(repeated: int) -> int:
    """Bits that index the table of so many repeated grams."""
    return min(max((8 * repeated).bit_length(), FILTER_BITS), MOST_FILTER_BITS)


def table_places(h: np.ndarray, bits: int) -> np.ndarray:
    """Place of each hash in the table, by its low bits: by the high ones all anchors would meet in a small part of it."""
    return (h & np.uint64((1 << bits) - 1)).astype(np.int64)


def table_holds(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set in the packed table, the size of which is a power of two."""
    at = table_places(h, (8 * len(table)).bit_length() - 1)
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


RUN = "part long, commons binary, rests binary, lefts binary, low binary, high binary, owners binary"
SPAN = "id long, mark long, start long, end long"


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, parts: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(id, mark, start, end)``: spans whose union is all bytes in strings of ``length`` that also stand earlier.

    ``rows`` are ``(id long, mark long, text binary)``. A gram with more than ``hot_rows`` places and more than a
    sixteenth of a part's share of all places is spread over the parts; that changes the work, not the result.
    """
    spark = rows.sparkSession
    reach = length - gram

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Anchors(length, gram)
        for batch in batches:
            for _, _, data, ends in _slices(batch, length):
                h, n = np.unique(finder.find(data, ends)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[int, np.ndarray] = {}
        for batch in batches:
            at = table_places(batch.column(0).to_numpy().view(np.uint64), bits)
            for chunk in np.unique(at >> CHUNK_BITS).tolist():
                own = chunks.setdefault(chunk, np.zeros(1 << CHUNK_BITS, bool))
                own[at[at >> CHUNK_BITS == chunk] & (1 << CHUNK_BITS) - 1] = True
        packed = [np.packbits(c).tobytes() for c in chunks.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(chunks), pa.int64()), pa.array(packed, pa.binary())], names=["chunk", "bits"])

    counts = land(rows.mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1"), "grams")
    repeated, total = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    bits = table_bits(repeated)
    chunk = F.shiftright(F.col("h").bitwiseAND(F.lit((1 << bits) - 1)), CHUNK_BITS)
    found = np.zeros(1 << bits - 3, np.uint8)
    for row in counts.select("h").repartition(chunk).mapInArrow(table, "chunk long, bits binary").toLocalIterator():
        found[row.chunk << CHUNK_BITS - 3 : (row.chunk + 1) << CHUNK_BITS - 3] |= np.frombuffer(row.bits, np.uint8)
    shared = spark.sparkContext.broadcast(found.tobytes())
    del found
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Frequent grams: less than 16 a part, as each has more than a sixteenth of a part's share of the suffixes.
    frequent = counts.where(F.col("n") > max(hot_rows, total // (16 * (parts or parts_for(total, tasks))))).collect()
    # Each of their places stands for half of all distances on average.
    parts = parts or parts_for(total + sum(r.n for r in frequent) * reach // 2, tasks)
    hot = spark.sparkContext.broadcast(np.sort(np.array([r.h for r in frequent], np.int64)).tobytes())

    def distinct(part: np.ndarray, full: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes by part and bytes, each kind once, and the spans of the copies."""
        words = full.view(">u8")
        order = np.lexsort((owner[:, 2], owner[:, 1], owner[:, 0], *words.T[::-1], part))
        words, owner = words[order], owner[order]
        same = np.concatenate(([False], (words[1:] == words[:-1]).all(axis=1)))
        head = np.flatnonzero(~same)[np.cumsum(~same) - 1]
        again = same & (owner[:, 0] > owner[head, 0])
        fresh = ~same
        fresh[1:] |= (owner[1:, :2] != owner[:-1, :2]).any(axis=1)
        again |= owner[:, 2] > owner[np.flatnonzero(fresh)[np.cumsum(fresh) - 1], 2]
        o, (low, high) = owner[again], full[order[again], length + reach : length + reach + 2].astype(np.int64).T
        return order[~again], np.column_stack((o[:, :2], o[:, 2] - high, o[:, 2] - low + length))

    def rows_of(part: np.ndarray, full: np.ndarray, owner: np.ndarray) -> Iterator[tuple]:
        """Sorted suffixes as runs by part."""
        left, low, high = full[:, length : length + reach], full[:, length + reach], full[:, length + reach + 1]
        edges = np.append(np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))), len(part)).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            commons, rests = front_code(full[a:b, :length])
            yield int(part[a]), commons.tobytes(), packed_bytes(rests), packed_bytes(left[a:b].tobytes()), low[a:b].tobytes(), high[a:b].tobytes(), packed_longs(owner[a:b])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen = Anchors(length, gram), np.frombuffer(shared.value, np.uint8)
        often = np.frombuffer(hot.value, np.int64).view(np.uint64)
        pool, gone = [], []

        def flush() -> Iterator[pa.RecordBatch]:
            """Runs of the pool. What is known to go already travels with them, so that nothing is done twice."""
            packed = [np.concatenate(column) for column in zip(*pool, strict=True)]
            pool.clear()
            order, known = distinct(*packed)
            cols = [(int(k[0, 1] % parts), None, None, None, None, None, k.astype(np.int64).tobytes()) for k in (*gone, known) if len(k)]
            cols += rows_of(*(column[order] for column in packed))
            gone.clear()
            arrays = [pa.array(c, pa.int64() if k == 0 else pa.binary()) for k, c in enumerate(zip(*cols, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names=[field.split()[0] for field in RUN.split(", ")])

        for batch in batches:
            ids, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for at_rows, offsets, data, ends in _slices(batch, length):
                begins = np.concatenate(([0], ends[:-1]))

                def entries(place: np.ndarray, h: np.ndarray, first: np.ndarray, last: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                    """Part, bytes (suffix, left, low and high) and owner of suffixes."""
                    doc = np.searchsorted(ends, place, side="right")
                    begin = begins[doc]
                    # Only as much of the text on either side as the strings of this suffix reach.
                    suffix = _gathered(data, place, length, begin, last + length)
                    left = np.zeros((len(place), length - gram), np.uint8)
                    if reach:
                        left = _gathered(data, place - reach, reach, first, ends[doc])[:, ::-1]
                    low, high = (place - last).astype(np.uint8), (place - first).astype(np.uint8)
                    # Low and high tell how much of either side is text, so padding is never taken for it.
                    whole = np.concatenate((suffix, left, low[:, None], high[:, None]), axis=1)
                    full = np.zeros((len(whole), whole.shape[1] + (-whole.shape[1]) % 8), np.uint8)
                    full[:, : whole.shape[1]] = whole
                    return parts_of(h, parts).astype(np.int64), full, np.column_stack((ids[at_rows[doc]], marks[at_rows[doc]], place - begin + offsets[doc]))

                place, h, first, last = finder.find(data, ends)
                keep = table_holds(seen, h)
                place, h, first, last = place[keep], h[keep], first[keep], last[keep]
                many = np.isin(h, often)
                if many.any():
                    # Strings at frequent anchors go on one by one, under hashes of their own: those that cross
                    # the border of a frequent passage then meet in many parts, and those within it once per slice.
                    order, known = distinct(*entries(place[many], h[many], first[many], last[many], reach))
                    at = np.flatnonzero(many)[order]
                    n = last[at] - first[at] + 1
                    starts = np.repeat(first[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    own = entries(starts, finder.string_hashes(starts), starts, starts, 0)
                    order, again = distinct(*own)
                    pool.append(tuple(column[order] for column in own))
                    gone += [known, again]
                if not many.all():
                    pool.append(entries(place[~many], h[~many], first[~many], last[~many], reach))
                if sum(len(p[0]) for p in pool) >= POOL_ROWS:
                    yield from flush()
        if pool:
            yield from flush()

    def span_batch(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["id", "mark", "start", "end"])

    def merged(runs: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Spans found in all runs of one part."""
        commons = [np.frombuffer(r[1], np.uint8) for r in runs]
        rests = (pa.decompress(r[2], len(c) * length - int(c.sum(dtype=np.int64)), CODEC, asbytes=True) for c, r in zip(commons, runs, strict=True))
        strings = [(front_decode(c, rest, length), c.tolist()) for c, rest in zip(commons, rests, strict=True)]
        offsets = np.concatenate(([0], np.cumsum([len(c) for c in commons])))
        if offsets[-1] < 2:
            return
        order, right = np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64)
        for k, (run, index, common) in enumerate(merge_runs(strings)):
            order[k], right[k] = offsets[run] + index, common
        del strings
        # A gram that stands alone has no partner; its neighbours share less than a gram with it.
        inner = right >= gram
        inner[:-1] |= inner[1:]
        right = right[inner]
        order = order[inner]
        if not len(order):
            return
        lefts = [pa.decompress(r[3], len(c) * reach, CODEC, asbytes=True) for c, r in zip(commons, runs, strict=True)]
        left = np.frombuffer(b"".join(lefts), np.uint8).reshape(-1, reach)[order]
        low, high = (np.concatenate([np.frombuffer(r[c], np.uint8) for r in runs])[order].astype(np.int64) for c in (4, 5))
        owner = np.concatenate([unpacked_longs(r[6], len(c), 3) for c, r in zip(commons, runs, strict=True)])[order]
        least, most = repeated_strings(right, left, low, high, owner[:, 0], owner[:, 1], owner[:, 2], length)
        hit = most >= 0
        yield span_batch(owner[hit, 0], owner[hit, 1], owner[hit, 2] - most[hit], owner[hit, 2] - least[hit] + length)

    def merge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = None, []
        pa.default_memory_pool().release_unused()  # what this worker's scans have left
        for batch in batches:
            for k in range(batch.num_rows):
                row = tuple(c[k].as_py() for c in batch.columns)
                if row[0] != part and runs:
                    yield from merged(runs)
                    runs = []
                part = row[0]
                if row[1] is None:
                    yield span_batch(*np.frombuffer(row[6], np.int64).reshape(-1, 4).T)
                else:
                    runs.append(row)
        if runs:
            yield from merged(runs)

    tasks = min(tasks, parts)
    runs = rows.mapInArrow(send, RUN).repartitionById(tasks, (F.col("part") % tasks).cast("int")).sortWithinPartitions("part")
    return runs.mapInArrow(merge_parts, SPAN)


def dedup_strings(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, parts: int | None = None, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``(id, n_bytes, removed, kept)``, a row per row of ``docs``.

    ``removed`` are the maximal byte spans that strings of ``length`` bytes cover which also start earlier: in a
    document with a smaller id, or earlier in the same one, where copies may overlap. Texts are bytes of UTF-8;
    a NULL text is empty. Ids are whole numbers. Rows that share an id are ties and keep each other's strings; a
    NULL id ranks last, and rows with a NULL id are ties. Other columns are ignored. An empty table gives no rows.
    """
    if not 8 <= gram < length <= 255:
        raise ValueError("needs 8 <= gram < length <= 255")
    text = F.col(text_col).cast("string").cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit(b"")).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("mark"), "text")
    ranked = rows.select(F.coalesce(F.col("id").cast("long"), F.lit(int(NO_ID))).alias("id"), "mark", "text")
    spans = repeated_spans(ranked, length, gram, parts, hot_rows)
    grouped = spans.groupBy(F.col("id").alias("of"), F.col("mark").alias("marked")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    same = (F.coalesce(F.col("id").cast("long"), F.lit(int(NO_ID))) == F.col("of")) & (F.col("mark") == F.col("marked"))
    joined = rows.join(grouped, same, "left").select("id", F.col("text").cast("string").alias("text"), "spans")
    return remove_spans(joined).withColumnRenamed("id", id_col)
