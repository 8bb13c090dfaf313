"""Quality scores by a regularised quadratic discriminant over document statistics.

Each class gets a mean and a shrunken covariance of the transformed statistics. A score is the logistic of
the difference of the two log densities, whose Mahalanobis terms come from Cholesky factors that are
computed once, on the driver, from sums over all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.workspace import land

BLANKS = b" \t\n\r\x0b\x0c"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>{}[]\\^~=+@_/"
STOPS = b".,;:?"
SHOUTS = b"!"
CONTINUATION = bytes(range(0x80, 0xC0))
HIGH = bytes(range(0xC0, 0x100))

FEATURES = ["words", "word_length", "long_words", "upper", "digits", "symbols", "stops", "shouts", "accents", "symbol_words", "distinct_words", "echoes", "repeated_lines", "line_length", "blank_share"]
SCORE_AT = 0.7


def _share(part: float, whole: float) -> float:
    """A share on the angle scale, which evens out its variance."""
    return float(np.arcsin(np.sqrt(min(max(part / whole, 0.0), 1.0)))) if whole else 0.0


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``FEATURES``; an empty text gives zeros."""

    def count(letters: bytes) -> int:
        return len(text) - len(text.translate(None, letters))

    words = text.split()
    n = len(words)
    chars = len(text) - count(CONTINUATION)
    blanks = count(BLANKS)
    solid = chars - blanks
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    marked = sum(1 for w in words if w[-1] in SYMBOLS)
    return [
        float(np.log1p(n)),
        float(np.log1p(solid / n)) if n else 0.0,
        _share(sum(1 for w in words if len(w) > 12), n),
        _share(count(UPPER), solid),
        _share(count(DIGITS), solid),
        _share(count(SYMBOLS), solid),
        _share(count(STOPS), solid),
        _share(count(SHOUTS), solid),
        _share(count(HIGH), solid),
        _share(marked, n),
        float(np.log1p(len(set(words)) / np.sqrt(n))) if n else 0.0,
        _share(sum(1 for a, b in zip(words, words[1:], strict=False) if a == b), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / len(lines))) if lines else 0.0,
        _share(blanks, chars),
    ]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, x)``: the statistics of every row as an array; a NULL text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["id", "x"])

    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(run, f"id {kept.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Two fitted classes: means, inverse Cholesky factors of the covariances, and constants of the log densities."""

    means: np.ndarray
    whiten: np.ndarray
    offsets: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability-like scores of label 1; the same for all rows if a class had no rows to learn from."""
        if not len(self.means):
            return np.full(len(x), self.base)
        z = np.einsum("cij,ncj->nci", self.whiten, x[:, None, :] - self.means[None])
        logs = self.offsets - 0.5 * (z**2).sum(axis=2)
        return 1 / (1 + np.exp(-np.clip(logs[:, 1] - logs[:, 0], -40, 40)))


def _sums(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of products per class. A few numbers per class reach the driver, however many rows there are."""
    width = len(FEATURES) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {0: np.zeros((width, width)), 1: np.zeros((width, width))}
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), np.float64).reshape(-1, width - 1)
            x = np.concatenate((np.ones((len(x), 1)), x), axis=1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for label in total:
                total[label] += x[y == label].T @ x[y == label]
        ij = np.indices((width, width)).reshape(2, -1)
        for label, m in total.items():
            columns = [np.full(width * width, label), ij[0], ij[1], m.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["label", "i", "j", "value"])

    parts = rows.select("x", "label").mapInArrow(run, "label long, i long, j long, value double")
    out = {0: np.zeros((width, width)), 1: np.zeros((width, width))}
    for r in parts.groupBy("label", "i", "j").agg(F.sum("value").alias("value")).collect():
        out[r.label][r.i, r.j] = r.value
    return {label: (m[0, 0], m[0, 1:], m[1:, 1:]) for label, m in out.items()}


def fit(rows: DataFrame, shrinkage: float = 0.1, ridge: float = 1e-3) -> Discriminant:
    """Fit on all rows of ``(x, label)`` with label 0 or 1.

    A class covariance is pulled by ``shrinkage`` towards the diagonal of the pooled one, and ``ridge`` is added,
    so constant or collinear statistics do no harm.
    """
    sums = _sums(rows)
    n = np.array([sums[0][0], sums[1][0]])
    base = float((n[1] + 1) / (n.sum() + 2))
    if not n.all():
        return Discriminant(np.zeros((0, len(FEATURES))), np.zeros((0, 0, 0)), np.zeros(0), base)
    means = np.array([sums[k][1] / n[k] for k in (0, 1)])
    own = np.array([sums[k][2] / n[k] - np.outer(means[k], means[k]) for k in (0, 1)])
    pooled = np.diag((own * n[:, None, None]).sum(axis=0).diagonal() / n.sum())
    shrunk = (1 - shrinkage) * own + shrinkage * pooled + ridge * np.eye(len(FEATURES))
    factors = np.linalg.cholesky(shrunk)
    logdet = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    return Discriminant(means, np.linalg.inv(factors), np.log(n / n.sum()) - logdet, base)


def score(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``(id, score)`` for rows of ``(id, x)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=["id", "score"])

    return rows.select("id", "x").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def held_out(row_id: Column) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, score)``, a row per row of ``docs``, learnt from the labels of rows that are not held out.

    All such rows are used. Labels other than 0 and 1, and NULL ones, are ignored; a repeated label or document
    counts as often as it occurs. Without rows of either class all scores are the smoothed share of label 1. A
    NULL id is never labelled and not held out; a NULL text counts as empty. Other columns are ignored. An empty
    table gives no rows.
    """
    rows = land(document_statistics(docs, id_col, text_col), "statistics")
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("long").alias("label")).where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    model = fit(rows.join(marks, "id").select("x", "label"))
    return score(rows, model).select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score")
