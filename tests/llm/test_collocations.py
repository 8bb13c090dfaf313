import random
import re
from collections import Counter

import numpy as np
import pytest

from rillflow.llm.collocations import added, collocations, frequent, parts, phrase_counts

MARK, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def slow_counts(rows, depth=3):
    """Counts of phrases of every length by language, and numbers of words."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in MARK.split(lowered(text)):
            words = WORD.findall(piece)
            totals[lang] += len(words)
            for size in range(1, depth + 1):
                counts.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return counts, totals


def slow_collocations(rows, depth=3, least=10, top=2000, percent=50):
    counts, totals = slow_counts(rows, depth)
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    by_lang = {}
    for (lang, phrase), a in found.items():
        cuts = [(1000000 * a * a // (counts[lang, phrase[:k]] * counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        longer = [b for (other, whole), b in found.items() if other == lang and len(whole) > len(phrase) and any(whole[i : i + len(phrase)] == phrase for i in range(len(whole)))]
        if longer and 100 * max(longer) >= percent * a:
            continue
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), counts[lang, phrase[:k]], counts[lang, phrase[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, rows in by_lang.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1)
    )


@pytest.fixture(scope="module")
def phrases():
    """Languages of different size, a hot pair of words, phrases that hold others, ties, marks of all kinds."""
    pick = random.Random(3)
    words = [f"w{k}" for k in range(40)] + ["É", "ß字", "A", "a"]
    rows = []
    for k in range(120):
        own = [pick.choice(words) for _ in range(pick.randint(0, 60))]
        text = "".join(w + pick.choice([" ", " ", "  ", "\t", ". ", "\n", "\r\n", "?!", "\x0b"]) for w in own)
        rows.append((pick.choice(["en", "en", "en", "de", None, "und", ""]), text + " New York City" * pick.randint(0, 2) + " of the " + pick.choice(words)))
    rows += [("en", None), ("en", ""), (None, " \t\n"), ("fr", "seul"), ("en", " ".join(["la"] * 500)), ("en", "x y " * 4000), ("en", "z" * 5000 + " z")]
    return rows + rows[:20]


@pytest.fixture(scope="module")
def frame(spark, phrases):
    return spark.createDataFrame([(lang, text, "x", 1, 2) for lang, text in phrases], "lang string, text string, phrase string, n long, words int").repartition(3)


TINY = {"bucket_runs": 64, "slice_bytes": 700, "bucket_bytes": 4000}


@pytest.mark.parametrize("sizes", [{}, TINY])
def test_counts_against_brute_force(frame, phrases, sizes):
    counts, totals = slow_counts(phrases)
    want = sorted((lang, len(phrase), " ".join(phrase), n) for (lang, phrase), n in counts.items() if n >= 3)
    rows = phrase_counts(frame, least=3, **sizes).collect()
    assert sorted((r.lang, r.words, r.phrase, r.n) for r in rows if r.words) == want
    assert {r.lang: r.n for r in rows if not r.words} == {lang: n for lang, n in totals.items() if n}


@pytest.mark.parametrize(("depth", "top", "sizes"), [(3, 2000, {}), (3, 5, TINY), (4, 2000, {}), (2, 2000, TINY)])
def test_collocations_against_brute_force(frame, phrases, depth, top, sizes):
    got = collocations(frame, depth=depth, top=top, least=6, **sizes).drop("words").collect()
    assert sorted(map(tuple, got)) == slow_collocations(phrases, depth, 6, top)


def test_exact_scores_beyond_64_bits(spark):
    quotient = spark.sql("select (1000000bd * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as q from values (9876543210123L, 9876543210124L, 9999999999999L) t(a, l, r)")
    assert quotient.first().q == 1000000 * 9876543210123**2 // (9876543210124 * 9999999999999)


def test_edge_rows(docs, small_docs, no_docs):
    got = collocations(docs, least=5).drop("words").collect()
    assert sorted(map(tuple, got)) == slow_collocations([(r[2], r[1]) for r in small_docs], least=5)
    assert collocations(no_docs).collect() == []
    with pytest.raises(ValueError):
        phrase_counts(no_docs, depth=1)


def test_parts_keep_every_start():
    pick = random.Random(1)
    for _ in range(300):
        data = "".join(pick.choice("ab .") for _ in range(pick.randint(0, 80))).encode()
        want = Counter(g for piece in data.split(b".") for w in [piece.split()] for k in range(len(w)) for g in [tuple(w[k : k + 3])])
        got = Counter()
        for part, extra in parts(data, pick.randint(2, 20), 2):
            opens = []
            for piece in part.split(b"."):
                w = piece.split()
                opens += [tuple(w[k : k + 3]) for k in range(len(w))]
            got.update(opens[: len(opens) - extra])
        assert got == want


def test_quicksort_against_counts():
    pick = np.random.default_rng(2)
    runs = pick.integers(0, 6, (3000, 3)).astype(np.int32)
    runs[runs[:, 0] == 0, 0] = 1
    runs[runs[:, 1] == 0, 2] = 0
    counts = pick.integers(1, 4, 3000)
    runs, counts = added(runs, counts, 6)
    got = {tuple(runs[k, :length].tolist()): w for length, first, total in frequent(runs, counts, 1, 3, 30) for k, w in zip(first, total.tolist(), strict=True)}
    want = Counter()
    for run, n in zip(runs.tolist(), counts.tolist(), strict=True):
        size = run.index(0) if 0 in run else 3
        want.update({tuple(run[:k]): n for k in range(1, size + 1)})
    assert got == {k: n for k, n in want.items() if n >= 30}
