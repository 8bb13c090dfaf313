import random
from collections import Counter

import numpy as np
import pytest

from rillflow.llm.queries import op10_unit_dedup
from rillflow.llm.spans import cut, merge
from rillflow.llm.unit_dedup import dedup_units, normalise, units


def slow(rows, kinds, min_words):
    """Removed spans and kept bytes per row, by comparing every unit with all earlier ones."""
    places = []
    for k, (i, text) in enumerate(rows):
        for digest, start, end in units((text or "").encode(), kinds, min_words):
            places.append((digest, np.inf if i is None else i, k, start, end))
    first = {}
    for digest, i, *_ in places:
        first[digest] = min(first.get(digest, np.inf), i)
    out = []
    for k, (i, text) in enumerate(rows):
        rank = np.inf if i is None else i
        seen, gone = set(), set()
        for digest, _, row, start, end in places:
            if row == k:
                if rank > first[digest] or digest in seen:
                    gone.update(range(start, end))
                seen.add(digest)
        body = (text or "").encode()
        out.append((i, len(body), len(gone), bytes(b for at, b in enumerate(body) if at not in gone)))
    return Counter(out)


@pytest.mark.parametrize(("kinds", "least"), [(("line", "sentence"), 8), (("line",), 1), (("paragraph", "sentence"), 2)])
def test_edge_rows_against_brute_force(docs, small_docs, kinds, least):
    got = Counter((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), bytes(r.kept)) for r in dedup_units(docs, kinds, least).collect())
    assert got == slow([(r[0], r[1]) for r in small_docs], kinds, least)


def test_no_rows(no_docs):
    assert dedup_units(no_docs).collect() == []


def test_offsets_are_of_the_original(spark):
    rows = [(1, "One two three four.\nä b c d e f g h i"), (2, "x\nÄ b, c d e f g h i!\nNew text of this one here. one TWO three, four"), (3, "ä b c d e f g h i \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in dedup_units(df, ("line", "sentence"), 4).collect()}
    assert got[1].removed == [] and bytes(got[1].kept).decode() == rows[0][1]
    for i in (2, 3):
        body = rows[i - 1][1].encode()
        assert cut(body, np.array([(s.start, s.end) for s in got[i].removed])) == bytes(got[i].kept)
    assert bytes(got[3].kept) == b""
    assert bytes(got[2].kept).decode() == "x\nÄ b, c d e f g h i!\nNew text of this one here. "  # non-ASCII letters keep their case


def test_passages_of_short_lines(spark):
    """A list of short lines goes wherever it stands again, and a text with too few words stays."""
    listed = "red\ngreen one\n\nblue two three\nfour\nfive six\n"
    rows = [(1, f"Start\n{listed}end\n"), (2, f"other words\nhere\n{listed}and a long last line that is no part of any run"), (3, "red\ngreen one\n")]
    got = {r.doc_id: bytes(r.kept).decode() for r in dedup_units(spark.createDataFrame(rows, "doc_id long, text string"), ("line",), 8).collect()}
    assert got == {1: rows[0][1], 2: "other words\nhere\nand a long last line that is no part of any run", 3: rows[2][1]}


def test_normalise():
    assert normalise(b"  A,b\t-\nC1 \xc3\xa4! ") == b"a b c1 \xc3\xa4"


def test_merge_of_spans():
    pick = random.Random(4)
    for _ in range(200):
        spans = [(a, a + pick.randint(1, 6)) for a in (pick.randrange(30) for _ in range(pick.randrange(6)))]
        merged = merge(np.array(spans, np.int64).reshape(-1, 2))
        assert {x for a, b in merged.tolist() for x in range(a, b)} == {x for a, b in spans for x in range(a, b)}
        assert all(merged[k, 1] < merged[k + 1, 0] for k in range(len(merged) - 1))


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in op10_unit_dedup(spark, sf_dir).collect()}
    assert got == {i: (n, gone) for i, n, gone, _ in slow(rows, ("paragraph", "line", "sentence"), 8)}
