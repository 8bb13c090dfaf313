from collections import Counter

import pytest

from rillflow.llm.decontamination import contained_items, decontaminate, shingles, words


def slow(rows, items, threshold=0.8, size=5):
    out = set()
    for i, text in rows:
        own = shingles(text, size)
        for j, item in items:
            wanted = shingles(item, size)
            if wanted and len(words(item)) < size:
                # A short item stands anywhere in the text, as words that follow each other.
                own_words, n = words(text), len(words(item))
                own_short = {tuple(own_words[k : k + n]) for k in range(len(own_words) - n + 1)}
                if own_short & wanted:
                    out.add((i, text, j, 1, 1))
            elif wanted and len(own & wanted) >= threshold * len(wanted):
                out.add((i, text, j, len(wanted), len(own & wanted)))
    return Counter((i, j, n, m) for i, _, j, n, m in out), {(i, text) for i, text, *_ in out}


@pytest.fixture(scope="module")
def items(small_docs):
    texts = [r[1] or "" for r in small_docs]
    prose = [t.split() for t in texts[:25]]
    long = texts[-8].split() if len(texts[-8].split()) > 500 else max(texts, key=lambda t: len(t.split())).split()
    out = [(k, " ".join(p[3:40]).upper()) for k, p in enumerate(prose[:8])]
    out += [(20, " ".join(long[5000:5100])), (21, "  ".join(long[19_000:19_007]) + "!"), (22, " ".join(long[100:105])), (23, "a"), (24, ""), (25, None), (26, "not in there at all, I hope")]
    out += [(27, " ".join(long[300:340] + prose[3][:10])), (28, " ".join(long[300:340] + prose[3][:9] + prose[4][:9])), (None, " ".join(prose[9])), (1, " ".join(prose[10])), (1, " ".join(prose[10]))]
    return out + [(29, " ".join(long)), (30, "same words again same words again"), (31, "again SAME words, again"), (32, "words words"), (33, "line - line line")]


def test_edge_rows_against_brute_force(spark, docs, small_docs, items):
    rows = [(r[0], r[1]) for r in small_docs]
    want, dirty = slow(rows, items)
    table = spark.createDataFrame([(j, t, "x", 1.0, 2) for j, t in items], "item_id long, text string, id string, h double, need int")
    got = contained_items(docs, table).collect()
    assert Counter((r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in got) == want
    assert {23, 29, 22, 21, 20, None} <= {j for _, j, *_ in want}
    kept = decontaminate(docs, table)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(r for r in rows if r not in dirty)


def test_empty_tables(spark, docs, no_docs, small_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(docs, none).collect() == []
    assert decontaminate(docs, none).count() == len(small_docs)
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert contained_items(no_docs, some).collect() == []


def test_clashing_names(spark):
    names = ["dirty_id", "dirty_mark", "own_row", "own_id", "own_mark", "mark", "id", "item", "h", "size"]
    rows = [(1, "one two three four five six", *range(10)), (2, "clean", *range(10))]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    items = spark.createDataFrame([(7, "one two three four five", "x")], "item_id long, text string, doc_id string")
    assert [tuple(r) for r in decontaminate(docs, items).collect()] == [rows[1]]
