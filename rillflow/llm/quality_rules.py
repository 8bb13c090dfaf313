"""Quality rules on repeated text, from a suffix array over the words of each document.

The suffix array is built by prefix doubling, for a slice of documents at once: ranks of word runs of
length 1, 2, 4, ... are refined, and only suffixes that still share their rank with another one of the
same document go on. Neighbours in the array give the longest common prefixes, whose intervals are the
maximal repeated word runs. The union of these runs and the longest of them decide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bytes of text handled at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
BLANKS = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Limits:
    """What a kept document must meet.

    ``run_words``: length from which a repeated run counts. The base rules: at least ``min_words`` words,
    of which at most ``max_repeat_percent`` lie in repeated runs. The verdict on repetition: at most
    ``max_covered_percent`` of the characters in words lie in repeated runs, and no run of more than
    ``max_run_words`` words occurs twice.
    """

    run_words: int = 8
    min_words: int = 20
    max_repeat_percent: int = 30
    max_covered_percent: int = 35
    max_run_words: int = 50


def suffix_ranks(words: np.ndarray, owner: np.ndarray, least: int) -> list[np.ndarray]:
    """Ranks of the word runs of length 1, 2, 4, ... at every position, up to unique ones.

    ``owner`` numbers the document of each word, ascending. Equal ranks mean equal runs within one document;
    a run cut off by the end of its document is smaller than any longer one. Runs that are unique at length
    ``least`` or below keep a unique rank from then on.
    """
    n = len(words)
    order = np.lexsort((words, owner))
    new = np.ones(n, bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels, step = [rank], 1
    shared = np.diff(np.append(heads, n)) > 1
    active = order[np.repeat(shared, np.diff(np.append(heads, n)))]
    while len(active):
        after = active + step
        inside = after < n
        inside[inside] = owner[after[inside]] == owner[active[inside]]
        second = np.full(len(active), -1, np.int64)
        second[inside] = rank[after[inside]]
        first = rank[active]
        order = np.lexsort((second, first))
        active, first, second = active[order], first[order], second[order]
        group = np.ones(len(active), bool)
        group[1:] = first[1:] != first[:-1]
        part = group.copy()
        part[1:] |= second[1:] != second[:-1]
        heads, starts = np.flatnonzero(group), np.flatnonzero(part)
        sizes = np.diff(np.append(starts, len(active)))
        of_group = heads[np.cumsum(group) - 1]
        rank = rank.copy()
        rank[active] = first + np.repeat(starts, sizes) - of_group
        levels.append(rank)
        active = active[np.repeat(sizes > 1, sizes)]
        step *= 2
    return levels


def longest_repeats(words: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """For every position, the longest word run starting there that occurs at another place of its document.

    Runs shorter than ``least`` may be given as zero.
    """
    found = np.zeros(len(words), np.int64)
    if not len(words):
        return found
    levels = suffix_ranks(words, owner, least)
    base = levels[max(k for k in range(len(levels)) if 1 << k <= max(least, 1))]
    # Only positions that share a run of about that length with another one have neighbours worth comparing.
    count = np.bincount(base, minlength=len(words))
    live = np.flatnonzero(count[base] > 1)
    array = live[np.argsort(levels[-1][live])]  # the suffix array
    if len(array) < 2:
        return found
    left, right = array[:-1].copy(), array[1:].copy()
    common = np.zeros(len(left), np.int64)
    n = len(words)
    for k in reversed(range(len(levels))):
        inside = (left < n) & (right < n)
        same = np.zeros(len(left), bool)
        a, b = left[inside], right[inside]
        same[inside] = (levels[k][a] == levels[k][b]) & (owner[a] == owner[b])
        # Beyond the first word the owner must still be that of the start.
        same &= owner[np.minimum(left, n - 1)] == owner[array[:-1]]
        same &= owner[np.minimum(right, n - 1)] == owner[array[1:]]
        common[same] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    found[array[:-1]] = common
    found[array[1:]] = np.maximum(found[array[1:]], common)
    return found


def measure(texts: list[bytes], limits: Limits) -> dict[str, np.ndarray]:
    """Counts of a slice of documents, one array per measure."""
    table: dict[bytes, int] = {}
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    words = np.fromiter((table.setdefault(w, len(table)) for own in split for w in own), np.int64, int(sizes.sum()))
    marks = bytes.maketrans(b"", b"")
    lengths = np.fromiter((len(w.translate(marks, CONTINUATION)) for w in table), np.int64, len(table))
    owner = np.repeat(np.arange(len(texts)), sizes)
    longest = longest_repeats(words, owner, limits.run_words)
    long = np.flatnonzero(longest >= limits.run_words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, long, 1)
    np.add.at(edge, long + longest[long], -1)
    covered = np.cumsum(edge[:-1]) > 0

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, len(texts)).astype(np.int64)

    chars = lengths[words] if len(words) else words
    top = np.zeros(len(texts), np.int64)
    np.maximum.at(top, owner, longest * (longest >= limits.run_words))
    symbols, repeated_lines = [], []
    for text in texts:
        symbols.append(len(text) - len(text.translate(marks, SYMBOLS)))
        lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
        repeated_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": sizes,
        "word_chars": total(chars),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(repeated_lines, np.int64),
        "n_repeat_words": total(covered.astype(np.int64)),
        "n_repeat_chars": total(chars * covered),
        "longest_repeat": top,
    }


def judge(counts: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """``(base_failed, kept)``."""
    failed = (counts["n_words"] < limits.min_words) | (100 * counts["n_repeat_words"] > limits.max_repeat_percent * counts["n_words"])
    too_covered = 100 * counts["n_repeat_chars"] > limits.max_covered_percent * counts["word_chars"]
    return failed, ~failed & ~too_covered & (counts["longest_repeat"] <= limits.max_run_words)


def _slices(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``SLICE_BYTES``, with the index of their first row."""
    start, own, size = 0, [], 0
    for k, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if own and size + len(text or b"") > SLICE_BYTES:
            yield start, own
            start, own, size = k, [], 0
        own.append(text or b"")
        size += len(text or b"")
    if own:
        yield start, own


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_repeat_chars", "longest_repeat"]


def quality_rules(docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_repeat_chars, longest_repeat, base_failed, kept)``.

    One row per row of ``docs``. Words are what spaces and ``\\t \\n \\v \\f \\r`` separate. A NULL, empty or
    blank text has no words and fails. Rows with a NULL or repeated id are judged like others, and other
    columns are ignored. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch.column(1)):
                counts = measure(texts, limits)
                columns = [batch.column(0).slice(start, len(texts)), *(pa.array(counts[m]) for m in MEASURES), *map(pa.array, judge(counts, limits))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [id_col, *MEASURES, "base_failed", "kept"]
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, ", ".join([f"`{id_col}` {kind}", *(f"{m} long" for m in MEASURES), "base_failed boolean", "kept boolean"]))


def keep_good(docs: DataFrame, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns, whatever their names."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _slices(batch.column(at)):
                kept = judge(measure(texts, limits), limits)[1]
                yield batch.slice(start, len(texts)).filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
