"""Maximal periodic runs of words, found by longest-common-extension queries on a harmonic grid.

A run of period ``p`` makes the words at ``i`` and ``i + p`` equal for a stretch of at least ``p`` positions (and of
``least - p``, as shorter runs do not count), so the stretch holds a point of the grid of that step. For every period
the grid points whose words agree are extended to both sides; all periods of a text of ``n`` words together have
``n log n`` points.

Common extensions come from a difference cover: of every ``COVER`` positions a few residues are sampled, such that
any two positions reach sampled ones after the same shift of less than ``COVER`` words. Only sampled suffixes are
sorted. A query compares words up to that shift, and from there takes the minimum of the common prefixes of
neighbours in the sorted sample, which a sparse table gives in two looks. The texts of a slice are sorted
together, apart by marks that occur once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.batches import text_slices

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
# Grid points looked at once.
GRID_POINTS = 1 << 21
# A difference cover modulo 31 (a perfect one: every difference other than zero occurs once).
COVER = 31
RESIDUES = (1, 5, 11, 24, 25, 27)
LEAST = 12

RUNS = "array<struct<start:long,length:long,period:long>>"


def _shifts() -> np.ndarray:
    """For residues ``(a, b)``, the least shift that takes both into the cover."""
    sampled = np.zeros(COVER, bool)
    sampled[list(RESIDUES)] = True
    out = np.zeros((COVER, COVER), np.int64)
    for a in range(COVER):
        for b in range(COVER):
            out[a, b] = next(d for d in range(COVER) if sampled[(a + d) % COVER] and sampled[(b + d) % COVER])
    return out


SHIFTS = _shifts()


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, head)``: rows sorted by the keys, and whether each begins a new value."""
    order = np.lexsort(keys[::-1])
    head = np.ones(len(order), bool)
    head[1:] = False
    for key in keys:
        own = key[order]
        head[1:] |= own[1:] != own[:-1]
    return order, head


def _refine(rank: np.ndarray, active: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Split the classes of ``active`` rows by ``second``, in place; returns the rows that still share a class.

    The rank of a class is the number of rows before it, so classes that do not change keep theirs.
    """
    first = rank[active]
    order, head = _groups(first, second)
    rows, first = active[order], first[order]
    opens = np.ones(len(rows), bool)
    opens[1:] = first[1:] != first[:-1]
    starts, at = np.flatnonzero(head), np.arange(len(rows))
    begin_class = np.maximum.accumulate(np.where(opens, at, 0))
    begin = np.maximum.accumulate(np.where(head, at, 0))
    rank[rows] = first + begin - begin_class
    sizes = np.diff(np.append(starts, len(rows)))
    return rows[np.repeat(sizes > 1, sizes)]


class CommonPrefixes:
    """Longest common prefixes of suffixes of ``words``, by a sorted sample of them.

    ``words`` must end with a value that occurs nowhere else.
    """

    def __init__(self, words: np.ndarray) -> None:
        n = len(words)
        # Past the end there are only marks that differ from all else; they are compared, never sorted.
        self.words = np.concatenate((words, -1 - np.arange(2 * COVER, dtype=words.dtype)))
        residues = np.array(RESIDUES)
        place = (np.arange(0, n, COVER)[:, None] + residues).ravel()
        self.place = place = place[place < n]
        self.row = np.full(n + 2 * COVER, -1, np.int64)
        self.row[place] = np.arange(len(place))
        if not len(place):
            return
        order, head = _groups(self.words[place])
        begin = np.maximum.accumulate(np.where(head, np.arange(len(place)), 0))
        rank = np.empty(len(place), np.int64)
        rank[order] = begin
        sizes = np.diff(np.append(np.flatnonzero(head), len(place)))
        active = order[np.repeat(sizes > 1, sizes)]
        # The first COVER words one by one, then by doubling: a sampled place plus COVER is sampled again.
        for offset in range(1, COVER):
            if not len(active):
                break
            active = _refine(rank, active, self.words[place[active] + offset])
        step = COVER
        levels = [rank.copy()] if len(active) else []
        while len(active):
            other = np.minimum(place[active] + step, n + COVER)
            row = self.row[other]
            # Suffixes that end here come first; at most one of a class does, as words differ past the end.
            active = _refine(rank, active, np.where(row < 0, -1, levels[-1][np.maximum(row, 0)]))
            step *= 2
            if len(active):
                levels.append(rank.copy())
        self.rank = rank
        array = np.empty(len(place), np.int64)
        array[rank] = np.arange(len(place))
        self._table(self._neighbours(place[array], levels))

    def _neighbours(self, sorted_places: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefix of every sampled suffix, in sorted order, with the next one."""
        a, b = sorted_places[:-1].copy(), sorted_places[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            x, y = self.row[a], self.row[b]
            same = (x >= 0) & (y >= 0)
            same[same] = levels[k][x[same]] == levels[k][y[same]]
            common[same] += COVER << k
            a[same] += COVER << k
            b[same] += COVER << k
        open_ = np.arange(len(a))
        for _ in range(COVER):
            open_ = open_[self.words[a[open_]] == self.words[b[open_]]]
            if not len(open_):
                break
            common[open_] += 1
            a[open_] += 1
            b[open_] += 1
        return common

    def _table(self, common: np.ndarray) -> None:
        """Minimums of stretches of 1, 2, 4, ... neighbours."""
        self.minimums = [common]
        width = 1
        while 2 * width <= len(common):
            last = self.minimums[-1]
            self.minimums.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of different sampled suffixes."""
        x, y = self.rank[self.row[a]], self.rank[self.row[b]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.minimums[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out

    def query(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from places ``a`` and ``b`` on; no ``a`` may equal its ``b``."""
        out = np.zeros(len(a), np.int64)
        shift = SHIFTS[a % COVER, b % COVER]
        open_ = np.arange(len(a))
        for step in range(COVER):
            done = shift[open_] == step
            if done.any():
                there = open_[done]
                out[there] = step + self._reached(a[there] + step, b[there] + step)
                open_ = open_[~done]
            if not len(open_):
                break
            same = self.words[a[open_] + step] == self.words[b[open_] + step]
            out[open_[~same]] = step
            open_ = open_[same]
        return out

    def _reached(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Sampled places, of which some may lie past the end."""
        inside = (self.row[a] >= 0) & (self.row[b] >= 0)
        out = np.zeros(len(a), np.int64)
        out[inside] = self._sampled(a[inside], b[inside])
        return out


@dataclass(frozen=True)
class Slice:
    """Word numbers of several texts, each followed by a mark of its own, and where each text begins."""

    words: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Slice:
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        words = np.empty(int(starts[-1]) + 1, np.int64)
        seen: defaultdict[bytes, int] = defaultdict()
        seen.default_factory = seen.__len__
        for own, start in zip(texts, starts.tolist(), strict=False):
            words[1 + start : 1 + start + len(own)] = np.fromiter(map(seen.__getitem__, own), np.int64, len(own))
        # Marks: one before the first text and one after each.
        words[np.concatenate(([0], starts[1:]))] = len(seen) + np.arange(len(texts) + 1)
        return cls(words, starts[:-1] + 1, sizes)


def _grid(work: Slice, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of ``(place, period)``: the points of the grids of all periods whose two words are equal."""
    top = np.maximum(work.sizes // 2, 0)
    for first, last in _blocks(work.sizes, top):
        text = np.repeat(np.arange(first, last), top[first:last])
        period = 1 + np.arange(len(text)) - np.repeat(np.cumsum(top[first:last]) - top[first:last], top[first:last])
        step = np.maximum(period, least - period)
        points = (work.sizes[text] - period + step - 1) // step
        cuts = np.append(0, np.cumsum(points))
        low = 0
        while low < len(text):
            high = max(low + 1, int(np.searchsorted(cuts, cuts[low] + GRID_POINTS, "right")) - 1)
            own = points[low:high]
            nth = np.arange(int(own.sum())) - np.repeat(cuts[low:high] - cuts[low], own)
            place = np.repeat(work.starts[text[low:high]], own) + nth * np.repeat(step[low:high], own)
            spread = np.repeat(period[low:high], own)
            equal = work.words[place] == work.words[place + spread]
            yield place[equal], spread[equal]
            low = high


def _blocks(sizes: np.ndarray, top: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about as many periods as points may be looked at once."""
    total = np.append(0, np.cumsum(top))
    low = 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(total, total[low] + GRID_POINTS, "right")) - 1)
        yield low, high
        low = high


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, start, length, period)`` of all runs, by text, start and period.

    A run is a stretch with smallest period ``p`` and at least ``max(least, 2 p)`` words which no neighbouring word
    extends.
    """
    work = Slice.of(texts)
    found = [np.zeros((0, 3), np.int64)]
    blocks = [(place, period) for place, period in _grid(work, least) if len(place)]
    if blocks:
        n = len(work.words)
        ahead, behind = CommonPrefixes(work.words), CommonPrefixes(work.words[::-1])
        for place, period in blocks:
            right = ahead.query(place, place + period)
            left = behind.query(n - place, n - place - period)
            # Several points of a grid may lie in one stretch.
            start, end = place - left, place + right + period
            good = (right + left >= period) & (end - start >= least)
            found.append(np.unique(np.column_stack((start, end, period))[good], axis=0))
    runs = np.concatenate(found)
    # The same stretch is found for every multiple of its period; the smallest is the period.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, end, period = runs[fresh].T
    text = np.searchsorted(work.starts, start, "right") - 1
    # Texts without words begin where the next one's mark stands, so the last start at or before is the right one.
    order = np.lexsort((period, start))
    return text[order], (start - work.starts[text])[order], (end - start)[order], period[order]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = np.cumsum(edge[:-1]) == 0
    return b" ".join([words[k] for k in np.flatnonzero(kept).tolist()])


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", collapsed: bool = True) -> DataFrame:
    """``(id, n_words, runs, collapsed)``, a row per row of ``docs``.

    ``runs`` has the start (a word number), length and period of every maximal run, by start and period;
    ``collapsed`` is the text with one period of each run, its words joined by single spaces (left out on request).
    Words are what spaces and ``\\t \\n \\v \\f \\r`` separate. A NULL, empty or blank text has no words, no runs and
    collapses to an empty text. Overlapping runs are all listed; of equal stretches only that with the smallest period
    is a run. Rows with a NULL or repeated
    id are looked at like others; other columns, whatever their names, are ignored. An empty table gives no rows. Texts
    are whole; the memory of a task grows with its longest text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE_BYTES):
                words = [t.split() for t in texts]
                text, *values = find_runs(words, least)
                offsets = np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(kind)))
                columns = [batch.column(0).slice(first, len(words)), pa.array([len(w) for w in words], pa.int64()), runs]
                if collapsed:
                    rows = list(zip(*(v.tolist() for v in values), strict=True))
                    kept = [collapse(w, rows[a:b]) for w, a, b in zip(words, offsets[:-1], offsets[1:], strict=True)]
                    columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, "n_words", "runs", *(["collapsed"] if collapsed else [])]
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    own = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {own}, n_words long, runs {RUNS}" + (", collapsed string" if collapsed else ""))


def longest_run(runs: str = "runs") -> Column:
    """The run with the greatest length; of equal ones the first, then that with the smallest period; NULL without runs."""
    order = F.transform(runs, lambda r: F.struct((-r["length"]).alias("by"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(order)
