import random
import re
from collections import Counter

import pytest

from rillflow.llm.line_dedup import dedup_lines, drop_repeated_lines


def slow(rows, least, long_words=None):
    """Kept text per row, by comparing windows of lines."""
    split = [[] if t is None else t.split("\n") for _, t in rows]
    solid = [[(k, line) for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)] for lines in split]

    def windows(lines):
        for size in range(1 if long_words is not None else least, least + 1):
            for at in range(len(lines) - size + 1):
                window = tuple(x for _, x in lines[at : at + size])
                if size == least or sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in window) > long_words:
                    yield window, [k for k, _ in lines[at : at + size]]

    first = {}
    for (i, _), lines in zip(rows, solid, strict=True):
        rank = float("inf") if i is None else i
        for window, _ in windows(lines):
            first[window] = min(first.get(window, float("inf")), rank)
    out = []
    for (i, text), lines, all_lines in zip(rows, solid, split, strict=True):
        rank, seen, gone = float("inf") if i is None else i, set(), set()
        for window, places in windows(lines):
            if window in seen or rank > first[window]:
                gone.update(places)
            seen.add(window)
        kept = None if text is None else "\n".join(line for k, line in enumerate(all_lines) if k not in gone)
        out.append((i, len(all_lines), tuple(sorted(gone)), kept))
    return out


def check(df, rows, least):
    want = slow(rows, least)
    got = Counter((r.doc_id, r.n_lines, tuple(r.removed), r.kept) for r in dedup_lines(df, least).collect())
    assert got == Counter(want)
    rest = drop_repeated_lines(df, least)
    assert rest.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in rest.collect()) == Counter((i, kept) for i, _, _, kept in want)


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_random_lines(spark, least):
    pick = random.Random(least)
    rows = [(k // 2, "\n".join(pick.choice(["a", "b", "b ", " ", "", "c\t"]) for _ in range(pick.randrange(25)))) for k in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, least)


@pytest.mark.parametrize("least", [2, 3, 4])
def test_runs_of_many_words(spark, least):
    pick = random.Random(least)
    rows = [(k // 2, "\n".join(pick.choice(["a", "b c", "d e f", " ", "g h i j k", "l"]) for _ in range(pick.randrange(25)))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.n_lines, tuple(r.removed), r.kept) for r in dedup_lines(df, least, long_words=4).collect())
    assert got == Counter(slow(rows, least, 4))


def test_edge_rows(docs, small_docs):
    for least in (1, 3):
        check(docs, [(r[0], r[1]) for r in small_docs], least)


def test_clashing_names(spark):
    names = ["of", "marked", "removed", "own_row", "own_text", "own_id", "own_mark", "id", "mark", "seq"]
    rows = [(1, "a\nb\nc", *range(10)), (2, "a\nb\nc\nd", *range(10)), (3, None, *range(10))]
    kept = drop_repeated_lines(spark.createDataFrame(rows, ["doc_id", "text", *names]))
    assert kept.columns == ["doc_id", "text", *names]
    assert sorted(map(tuple, kept.collect())) == [rows[0], (2, "d", *range(10)), rows[2]]


def test_no_rows(no_docs):
    assert dedup_lines(no_docs).collect() == [] and drop_repeated_lines(no_docs).collect() == []


def test_no_python_in_the_plan(docs):
    plan = drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def slow_long(rows, least, long_words):
    """Kept text per row: windows of ``least`` lines, and shorter ones of more than ``long_words`` words."""
    split = [t.split("\n") for _, t in rows]
    solid = [[(k, line) for k, line in enumerate(lines) if line.split()] for lines in split]
    gone = [set() for _ in rows]
    for size in range(1, least + 1):
        first, seen = {}, set()
        windows = [[lines[at : at + size] for at in range(len(lines) - size + 1)] for lines in solid]
        windows = [[w for w in own if size == least or len(" ".join(x for _, x in w).split()) > long_words] for own in windows]
        for (i, _), own in zip(rows, windows, strict=True):
            for w in own:
                text = tuple(x for _, x in w)
                first[text] = min(first.get(text, i), i)
        for r, ((i, _), own) in enumerate(zip(rows, windows, strict=True)):
            for w in own:
                text = tuple(x for _, x in w)
                if i > first[text] or (r, text) in seen:
                    gone[r].update(k for k, _ in w)
                seen.add((r, text))
    return Counter((i, "\n".join(line for k, line in enumerate(lines) if k not in out)) for (i, _), lines, out in zip(rows, split, gone, strict=True))


@pytest.mark.parametrize("least", [3, 5])
def test_short_runs_of_many_words(spark, least):
    pick = random.Random(least)
    lines = ["one two", "x", " ", "a b c d e f g h", "r s t u v w x y z q", "k l m n o p"]
    rows = [(k, "\n".join(pick.choice([*lines, f"own {k} {at}", f"own {k} {at}"]) for at in range(12))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = slow_long(rows, least, 9)
    assert Counter((r.doc_id, r.text) for r in drop_repeated_lines(df, least, long_words=9).collect()) == want
    assert Counter((r.doc_id, r.kept) for r in dedup_lines(df, least, long_words=9).collect()) == want != slow_long(rows, least, 99)
