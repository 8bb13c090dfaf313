import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import pii
from rillflow.llm.pii import KINDS, OUTSIDE, Generator, Lattice, Likelihood, Model, base_spans, find_spans, learn, luhn, personal_data, sample_words
from rillflow.llm.queries import op11_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_luhn(digits):
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits))) % 10 == 0


def slow_base(text):
    """The patterns as they are written, with their checks."""
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and slow_luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), number, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model():
    return learn(["alpha", "beta", "gamma", "Delta", "über"])


def test_luhn():
    pick = random.Random(1)
    for _ in range(500):
        digits = "".join(pick.choice("0123456789") for _ in range(pick.randint(1, 20)))
        assert luhn(digits) == slow_luhn(digits)


@pytest.mark.parametrize("letters", ["ab1@. ", "12. ", "0123456789 -+().", "+1 9-", "a@.-%+1_", "25.0+( )é٣"])
def test_base_against_the_patterns(letters):
    pick = random.Random(letters)
    for _ in range(4000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 40)))
        assert base_spans(text) == slow_base(text), text


def test_long_texts_take_linear_time(model):
    texts = ["1" * 1_000_000, "a" * 1_000_000 + "@", "@" * 200_000, "1." * 300_000, "+1 234 567 8901, " * 20_000, "1 " * 30_000, "a@" * 100_000, "(" * 300_000]
    for text in texts:
        base, spans = find_spans(text, model)
        assert set(base) <= set(spans)
    assert len(find_spans(texts[4], model)[0]) == 20_000


def segmentations(n, segments):
    """All ways to cut ``n`` tokens into segments and single tokens outside."""

    def walk(at):
        if at == n:
            yield []
            return
        for rest in walk(at + 1):
            yield [(at, at + 1, OUTSIDE, ()), *rest]
        for s in segments:
            if s[0] == at:
                for rest in walk(s[1]):
                    yield [s, *rest]

    return list(walk(0))


def score(way, weights, turns):
    total, last = 0.0, OUTSIDE
    for _, _, kind, features in way:
        total += turns[last, kind] + sum(weights[f] for f in features)
        last = kind
    return total


def lattices(seed):
    pick = random.Random(seed)
    for _ in range(12):
        n = pick.randint(1, 7)
        places = {(i, pick.randint(i + 1, n), pick.randrange(OUTSIDE)) for i in (pick.randrange(n) for _ in range(6))}
        yield Lattice(list(range(10, 11 + n)), [(*p, tuple(pick.sample("pqrst", 2))) for p in sorted(places)])


def test_best_segmentation_against_all():
    pick = np.random.default_rng(4)
    for own in lattices(4):
        weights, turns = dict(zip("pqrst", pick.normal(0, 2, 5).tolist(), strict=True)), pick.normal(0, 1, (OUTSIDE + 1,) * 2)
        best = max(segmentations(len(own.bounds) - 1, own.segments), key=lambda way: score(way, weights, turns))
        want = [(own.bounds[i], kind, own.bounds[j]) for i, j, kind, _ in best if kind != OUTSIDE]
        assert Model(weights, turns).decode(own) == want


def test_likelihood_and_gradient_against_all():
    pick = np.random.default_rng(5)
    marked = []
    for own in lattices(5):
        way = segmentations(len(own.bounds) - 1, own.segments)
        marked.append((own, {s[:3] for s in way[len(way) // 2] if s[2] != OUTSIDE}))
    names = {f: k for k, f in enumerate("pqrst")}
    slope = Likelihood(marked, names)
    weights, turns = pick.normal(0, 1, 5), pick.normal(0, 1, (OUTSIDE + 1,) * 2)

    def slow(weights, turns):
        total = 0.0
        for own, true in marked:
            ways = segmentations(len(own.bounds) - 1, own.segments)
            scores = [score(w, dict(zip("pqrst", weights, strict=True)), turns) for w in ways]
            own_way = next(k for k, w in enumerate(ways) if {s[:3] for s in w if s[2] != OUTSIDE} == true)
            total += scores[own_way] - np.logaddexp.reduce(scores)
        return total

    value, up, across = slope(weights, turns)
    assert value == pytest.approx(slow(weights, turns))
    for k in range(5):
        step = np.eye(5)[k] * 1e-5
        assert up[k] == pytest.approx((slow(weights + step, turns) - slow(weights - step, turns)) / 2e-5, abs=1e-4)
    for place in ((0, 1), (OUTSIDE, 2), (3, OUTSIDE)):
        step = np.zeros_like(turns)
        step[place] = 1e-5
        assert across[place] == pytest.approx((slow(weights, turns + step) - slow(weights, turns - step)) / 2e-5, abs=1e-4)


def test_held_out_entities(model):
    hits = wrong = missed = 0
    for own, true in Generator(["other", "words", "Here"], seed=77).marked(800):
        got = {(own.bounds.index(a), own.bounds.index(b), kind) for a, kind, b in model.decode(own)}
        hits, wrong, missed = hits + len(got & true), wrong + len(got - true), missed + len(true - got)
    assert hits / (hits + wrong) > 0.95 and hits / (hits + missed) > 0.95


def test_spans_that_run_into_other_digits(model):
    def added(text):
        base, spans = find_spans(text, model)
        return [(KINDS[k], text[a:b]) for a, k, b in spans if (a, k, b) not in base]

    assert added("call +1 (377) 555-0271 4371549438645903 now") == [("phone", "+1 (377) 555-0271")]
    assert added("call +1 (377) 555-0271 4371549438645904 now") == [("phone", "+1 (377) 555-0271"), ("card", "4371549438645904")]
    assert added("3 4539578763621486 it") == [("card", "4539578763621486")]
    assert added("write to anna (at) example.org or") == [("email", "anna (at) example.org")]
    assert added("phone (843) 555-4223.") == [("phone", "(843) 555-4223")]
    for clean in ["order 4371549438645903", "version 1.2.3.4.5.6", "on 2024-05-17 and 17.05.2024", "4.0. 76.", 'token = "27660c51feb63980dfaee7464f96210544c03fc3"']:
        assert added(clean) == [], clean


def test_edge_rows(docs, small_docs, no_docs, model, monkeypatch):
    monkeypatch.setattr(pii, "learn", lambda *_: model)
    got = sorted((repr(r.doc_id), [tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in personal_data(docs).collect())
    want = []
    for r in small_docs:
        both = [[(KINDS[k], a, b) for a, k, b in side] for side in find_spans(r[1] or "", model)]
        want.append((repr(r[0]), *both))
    assert got == sorted(want)
    assert personal_data(no_docs).collect() == []


def test_sample_is_bounded_and_leaves_copies_out(spark):
    rows = spark.range(3000).select("id", F.concat(F.lit("same "), F.chr(F.lit(97) + F.col("id") % 26), F.lit(" words")).alias("text"))
    words = sample_words(rows.union(rows), 50, 9, "id", "text")
    assert 50 < len(words) <= 150
    assert words == sample_words(rows.union(rows).repartition(3), 50, 9, "id", "text")
    one = spark.range(40).select(F.lit(1).alias("id"), F.lit("a copy").alias("text"))
    assert sample_words(one, 50, 400, "id", "text") in (["a", "copy"], [])


def test_no_documents_to_learn_from(no_docs):
    rows = personal_data(no_docs, training_islands=50)
    assert rows.columns == ["doc_id", "base", "spans"] and rows.collect() == []


def test_offsets_are_code_points(spark):
    text = "😀ß a.b@c.de 1.2.3.4"
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [tuple(s) for s in personal_data(rows, training_islands=50).first().base] == [("email", 3, 11), ("ip", 12, 19)]


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op11_pii(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = slow_base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in range(4)]
        listed = [f"{KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed) <= set(spans)
        places = [(int(a), KINDS.index(kind), int(b)) for kind, a, b in (s.split(":") for s in spans)]
        assert places == sorted(places)
        # What the model adds touches nothing else.
        for a, k, b in set(places) - set(base):
            assert not any(c < b and a < d for c, j, d in places if (c, j, d) != (a, k, b))
