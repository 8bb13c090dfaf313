import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from rillflow.llm.periodic_runs import COVER, CommonPrefixes, find_runs, longest_run, periodic_runs
from rillflow.llm.queries import op13_periodic_runs, planted_periods


def slow_runs(words, least=12):
    """All ``(start, length, period)``, by the definition."""
    n, found = len(words), {}
    for period in range(1, n // 2 + 1):
        at = 0
        while at + period < n:
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end - at + period
            if length >= max(least, 2 * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted((start, length, period) for (start, length), period in found.items())


def slow_collapse(words, runs):
    gone = {k for start, length, period in runs for k in range(start + period, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def cases(seed):
    pick = random.Random(seed)
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 300, ["a", "b"] * 100 + ["c"] + ["a", "b"] * 6]
    for _ in range(60):
        letters = "ab" if pick.random() < 0.5 else "abcdefgh"
        words = []
        while len(words) < pick.randint(1, 250):
            part = [pick.choice(letters) for _ in range(pick.randint(1, 20))]
            words += part * pick.randint(1, 5) + part[: pick.randint(0, len(part))]
        out.append(words)
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    return [*out, list(fib[-1])]


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_the_definition(seed):
    texts = cases(seed)
    text, *values = find_runs([[w.encode() for w in t] for t in texts])
    rows = list(zip(*(v.tolist() for v in values), strict=True))
    for k, words in enumerate(texts):
        assert [r for r, t in zip(rows, text.tolist(), strict=True) if t == k] == slow_runs(words)


@pytest.mark.parametrize("letters", [1, 2, 50])
def test_common_prefixes(letters):
    pick = np.random.default_rng(letters)
    words = np.append(pick.integers(0, letters, 40 * COVER), letters)
    own = CommonPrefixes(words)
    a, b = pick.integers(0, len(words), (2, 3000))
    a, b = a[a != b], b[a != b]
    for x, y, found in zip(a.tolist(), b.tolist(), own.query(a, b).tolist(), strict=True):
        want = 0
        while max(x, y) + want < len(words) and words[x + want] == words[y + want]:
            want += 1
        assert found == want


def test_edge_rows(docs, small_docs):
    got = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(docs).collect())
    want = []
    for row in small_docs:
        words = split(row[1])
        # The definition takes too long on the longest texts; they have no run, or one.
        if len(words) == 20_000:
            runs = slow_runs(words[:2000])
            assert runs == []
        elif len(words) > 5000:
            runs = [(0, len(words), 3)]
        else:
            runs = slow_runs(words)
        want.append((repr(row[0]), len(words), runs, slow_collapse(words, runs)))
    assert got == sorted(want)


def test_no_rows(no_docs):
    assert periodic_runs(no_docs).collect() == []
    assert periodic_runs(no_docs, collapsed=False).columns == ["doc_id", "n_words", "runs"]


def test_longest_run(spark):
    rows = spark.createDataFrame([([(5, 20, 4), (1, 20, 7), (1, 20, 3), (0, 12, 1)],), ([],)], "runs array<struct<start:long,length:long,period:long>>")
    first, second = [r.best for r in rows.select(longest_run().alias("best")).collect()]
    assert (first.start, first.length, first.period) == (1, 20, 3) and second is None


def planted(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_planted_periods(docs, small_docs):
    got = sorted((repr(r.doc_id), split(r.text)) for r in planted_periods(docs).collect())
    assert got == sorted((repr(r[0]), planted(r[0], r[1])) for r in small_docs)


def test_planting_in_texts_without_words(spark):
    """Ids that are chosen for planting, with texts that have no word or one."""
    chosen = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    rows = list(zip(chosen, ["", None, " \n", "one", "one two"], strict=True))
    got = {r.doc_id: split(r.text) for r in planted_periods(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: planted(i, text) for i, text in rows}


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op13_periodic_runs(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    checked = 0
    for r in rows:
        words = planted(r.doc_id, docs[r.doc_id])
        if len(words) > 500:
            continue
        runs = slow_runs(words)
        best = min(((-length, start, period) for start, length, period in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (r.n_runs, (r.start, r["length"], r.period, r.exponent_milli)) == (len(runs), want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(slow_collapse(words, runs).encode()).hexdigest()
        checked += bool(runs)
    assert checked > 50
