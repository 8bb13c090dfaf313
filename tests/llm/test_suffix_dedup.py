import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rillflow.llm import suffix_dedup
from rillflow.llm.queries import op3_suffix_dedup
from rillflow.llm.suffix_dedup import dedup_strings, front_code, front_decode, merge_runs


def slow(rows, length):
    """Removed spans per row, by looking every string up."""
    first = {}
    for i, text in rows:
        rank = float("inf") if i is None else i
        for at in range(len(text) - length + 1):
            w = text[at : at + length]
            first[w] = min(first.get(w, float("inf")), rank)
    out = []
    for i, text in rows:
        rank, seen, spans = float("inf") if i is None else i, set(), []
        for at in range(len(text) - length + 1):
            w = text[at : at + length]
            if rank > first[w] or w in seen:
                if spans and at <= spans[-1][1]:
                    spans[-1][1] = at + length
                else:
                    spans.append([at, at + length])
            seen.add(w)
        gone = {x for a, b in spans for x in range(a, b)}
        out.append((i, len(text), tuple(map(tuple, spans)), bytes(b for k, b in enumerate(text) if k not in gone)))
    return Counter(out)


def found(df, *args):
    return Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept)) for r in dedup_strings(df, *args).collect())


def test_edge_rows_against_brute_force(docs, small_docs):
    assert found(docs) == slow([(r[0], (r[1] or "").encode()) for r in small_docs], 100)


@pytest.mark.parametrize("hot_rows", [20_000, 3])
@pytest.mark.parametrize(("length", "gram", "parts"), [(30, 8, 3), (12, 10, 1), (100, 24, 40)])
def test_mutated_copies(spark, length, gram, parts, hot_rows):
    """Copies with edits anywhere, so that strings overlap, nest and cross each other's borders."""
    pick = random.Random(length)
    base = ["".join(pick.choice("ab c") for _ in range(pick.randint(50, 600))) for _ in range(4)]
    rows = []
    for k in range(60):
        text = list(pick.choice(base))
        for _ in range(pick.randrange(6)):
            at = pick.randrange(len(text))
            text[at : at + pick.randrange(3)] = pick.choice(["x", "", "yy", "é"])
        rows.append((pick.randrange(50), "".join(text) + ("ab" * 120 if k % 9 == 0 else "")))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(df, length, gram, parts, "doc_id", "text", hot_rows) == slow([(i, t.encode()) for i, t in rows], length)


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 700)
    pick = random.Random(6)
    shared = "".join(pick.choice("abcdef ") for _ in range(900))
    rows = [(k, "".join(pick.choice("abcdef ") for _ in range(pick.randrange(3000))) + shared[pick.randrange(300) :] + "z" * pick.randrange(300)) for k in range(6)]
    want = slow([(i, t.encode()) for i, t in rows], 100)
    ranked = [(i, i, bytearray(t.encode())) for i, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ranked, strict=True), (pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["id", "mark", "text"])
    assert all(len(data) <= 700 + 99 for *_, data, _ in suffix_dedup._slices(batch, 100))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_parts_of_anchors_are_alike():
    """Hashes of anchors are low ones; their parts must not be: the first of 40 would hold most of all suffixes."""
    data = np.random.default_rng(5).integers(97, 123, 400_000).astype(np.uint8)
    h = suffix_dedup.Anchors(100, 24).find(data, np.array([len(data)]))[1]
    assert np.mean(h >> np.uint64(32) < (1 << 32) // 40) > 0.5
    sizes = np.bincount(suffix_dedup.parts_of(h, 40).astype(np.int64), minlength=40)
    assert len(sizes) == 40 and sizes.max() < 1.5 * sizes.mean() and sizes.min() > 0.5 * sizes.mean()


def test_table_tells_repeated_grams_from_others():
    """Anchors that were not entered pass by chance only; by the high bits of their hashes a third would."""
    data = np.random.default_rng(6).integers(97, 123, 1_200_000).astype(np.uint8)
    h = suffix_dedup.Anchors(100, 24).find(data, np.array([len(data)]))[1]
    table = np.zeros(1 << 20, bool)
    table[suffix_dedup.table_places(h[::2], 20)] = True
    packed = np.packbits(table)
    assert suffix_dedup.table_holds(packed, h[::2]).all()
    assert table.mean() > 0.01 and suffix_dedup.table_holds(packed, h[1::2]).mean() < 1.5 * table.mean()


def test_table_grows_with_the_repeated_grams():
    assert [suffix_dedup.table_bits(n) for n in (0, 1 << 23, 1 << 25, 1 << 40)] == [27, 27, 29, 30]


def test_numbers_of_owners_are_packed():
    rows = np.random.default_rng(7).integers(-(1 << 63), (1 << 63) - 1, (500, 3))
    rows[:, 0] = np.arange(500)
    packed = suffix_dedup.packed_longs(rows)
    assert len(packed) < 8 * 500 * 3 * 0.8
    assert (suffix_dedup.unpacked_longs(packed, 500, 3) == rows).all()


@pytest.fixture
def sent(monkeypatch, tmp_path):
    """Numbers of suffixes of the runs that have been sent since the last call."""
    path, front = tmp_path / "runs", front_code

    def noted(rows):
        with open(path, "a") as out:
            out.write(f"{len(rows)}\n")
        return front(rows)

    def since():
        sizes = [int(n) for n in path.read_text().split()] if path.exists() else []
        path.write_text("")
        return sizes

    monkeypatch.setattr(suffix_dedup, "front_code", noted)
    return since


def test_suffixes_without_partner_stay(spark, monkeypatch, sent):
    """The table of 2^20 bits holds some 7,700 grams; of the 77,000 that stand once few may be sent."""
    monkeypatch.setattr(suffix_dedup, "FILTER_BITS", 20)
    pick = np.random.default_rng(9)
    texts = ["".join(map(chr, pick.integers(97, 123, 10_000))) for _ in range(330)]
    df = spark.createDataFrame(list(enumerate(texts + texts[:30])), "doc_id long, text string").coalesce(1)
    removed = {r.doc_id: [(s.start, s.end) for s in r.removed] for r in dedup_strings(df).collect()}
    assert removed == {k: [(0, 10_000)] if k >= 330 else [] for k in range(360)}
    assert 7_000 < sum(sent()) < 18_000


def test_runs_of_several_slices(spark, monkeypatch, sent):
    """Suffixes of many slices are one run a part, unless the pool is full."""
    pick = random.Random(8)
    shared = "".join(pick.choice("abcdef ") for _ in range(400))
    rows = [(k, "".join(pick.choice("abcdef ") for _ in range(pick.randrange(300))) + shared[pick.randrange(200) :]) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = slow([(i, t.encode()) for i, t in rows], 100)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(suffix_dedup, "POOL_ROWS", 1 << 16)
    spark.conf.set(batch, "3")
    try:
        assert found(df, 100, 24, 2) == want
        assert len(sent()) <= 2
        assert found(df, 100, 24, 2, "doc_id", "text", 3) == want
        assert len(sent()) <= 2
        monkeypatch.setattr(suffix_dedup, "POOL_ROWS", 1)
        assert found(df, 100, 24, 2) == want
        assert len(sent()) > 10
    finally:
        spark.conf.unset(batch)


def test_parts_follow_the_suffixes():
    assert [suffix_dedup.parts_for(n, 50) for n in (0, 5_000_000, 5_000_001, 10**9)] == [50, 50, 100, 10_000]


def test_no_rows(no_docs):
    assert dedup_strings(no_docs).collect() == []


def test_loser_tree():
    pick = random.Random(9)
    for count in (1, 2, 3, 7, 16, 21):
        runs = []
        for _ in range(count):
            rows = sorted(bytes(pick.choice(b"ab") for _ in range(12)) for _ in range(pick.randrange(1, 30)))
            commons, rests = front_code(np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 12))
            assert front_decode(commons, rests, 12) == rows
            runs.append((rows, commons.tolist()))
        merged = list(merge_runs(runs))
        strings = [runs[r][0][i] for r, i, _ in merged]
        assert strings == sorted(s for rows, _ in runs for s in rows)
        for k in range(1, len(strings)):
            common = next((i for i in range(12) if strings[k][i] != strings[k - 1][i]), 12)
            assert merged[k][2] == common


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text.encode()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {i: (n, sum(b - a for a, b in spans), len(spans)) for i, n, spans, _ in slow(rows, 100)}
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in op3_suffix_dedup(spark, sf_dir).collect()} == want
