import random
import re
from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rillflow.llm.queries import op7_secret_scan
from rillflow.llm.secrets import CANDIDATE, FEATURES, GIVEN_IN_TEXT, candidates, featured, review, scan, transitions, vocabulary


def slow_given(word, before, before2):
    name = r"(?:passw(?:or)?d|passphrase|pwd|secret|token|credentials?|(?:api|access|private|secret|auth)[_-]?key)[\"'`]?"
    inner = re.search(name + r"[=:]+[\"'`]?([^\x20\x09-\x0D\"'`]+)", word, re.IGNORECASE)
    value = inner[1] if inner else None
    if not inner and not re.fullmatch("[=:]+", word):
        named = re.search(name + r"[=:]+\Z", before or "", re.IGNORECASE)
        apart = re.fullmatch("[=:]+", before or "") and re.search(name + r"\Z", before2 or "", re.IGNORECASE)
        value = word if named or apart else None
    return re.sub(r"""^["'`(\[{<]+|["'`)\]}>,;.]+\Z""", "", value) if value else None


def slow_candidates(rows):
    out = set()
    for i, text in rows:
        words = re.split(r"[\x20\x09-\x0D]+", text or "")
        for at, word in enumerate(words):
            near = [words[k] if 0 <= k < len(words) else None for k in (at - 2, at - 1, at + 1)]
            long = re.findall(CANDIDATE, word)
            out.update((i, text, at, nth, c, *near) for nth, c in enumerate(long) if re.search("[0-9]", c))
            given = slow_given(word, near[1], near[0])
            if given and not (given in long and re.search("[0-9]", given)):
                out.add((i, text, at, len(long), given, *near))
    return Counter((i, *rest) for i, _, *rest in out)


@pytest.fixture(scope="module")
def spoken(spark, small_docs):
    """Texts with secrets, addresses, numbers and long names; true secrets by document."""
    pick = random.Random(11)
    texts = [r[1] for r in small_docs if r[1] and len(r[1]) < 2000]
    rows, truth = [], {}
    for k in range(400):
        secret = "".join(pick.choice("0123456789abcdef") for _ in range(40))
        kind = pick.randrange(5)
        part = [f'token = "{secret}"', f"some.one{k}@mail5.example.com", "4785380592391139", f"secret_key: {secret[:32]},", f"see http://www.example.com/plain/page{k}"][kind]
        truth[k] = kind in (0, 3)
        rows.append((k, f"{pick.choice(texts)} {part} {pick.choice(texts)}", "en", f"repo/src{k % 3}.py"))
    rows += [(500, None, None, None), (501, "", None, None), (502, "9" * 40_000, None, None), (None, 'token = "0f3a5b7c9d1e2f4a6b8c"', None, "a"), (3, rows[3][1], "en", "repo/src0.py")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("word", F.lit(1)).withColumn("length", F.lit("x")), rows, truth


def test_candidates_against_brute_force(spark, docs, small_docs, spoken):
    for df, rows in ((docs, small_docs), (spoken[0], spoken[1])):
        got = Counter((r.id, r.word, r.nth, r.candidate, r.before2, r.before, r.after) for r in candidates(df).collect())
        assert got == slow_candidates([(r[0], r[1]) for r in rows])


def test_features(spoken):
    df, rows, _ = spoken
    words = vocabulary(df).cache()
    bare = [re.sub(CANDIDATE, " ", re.sub(GIVEN_IN_TEXT, r"\1", r[1] or "")) for r in rows]
    runs = Counter(w for text in bare for w in re.split("[^a-z0]+", re.sub("[0-9]", "0", text.lower())) if w)
    least = 1e-3 * sum(runs.values())
    assert {r.token: r.n for r in words.collect()} == runs
    pairs = Counter()
    for w, n in runs.items():
        for a, b in zip(w, w[1:], strict=False):
            pairs[a + b] += n
    assert set(r.pair for r in transitions(words).collect()) == set(pairs)
    for r in featured(candidates(df), words, 1e-3).collect():
        runs_in = re.findall("[a-z]{3,}", r.candidate.lower())
        assert abs(r.coverage - sum(len(w) for w in runs_in if runs[w] >= least) / len(r.candidate)) < 1e-9
        assert r["length"] == len(r.candidate) and all(r[f] is not None for f in FEATURES)
        assert r.hex_only == bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", r.candidate))


def test_held_out_accuracy(spoken):
    df, _, truth = spoken
    rows = scan(df, review()).collect()
    judged = [(r.score >= 0.5, truth[r.doc_id]) for r in rows if r.doc_id in truth]
    assert len(judged) >= 400
    assert sum(a == b for a, b in judged) / len(judged) > 0.95


def test_labelled_findings_as_a_table(spark, spoken):
    df, _, truth = spoken
    found = candidates(df).collect()
    labels = spark.createDataFrame([(r.id, r.word, r.nth, int(truth[r.id]), "x") for r in found if r.id in truth and r.id < 200], "doc_id long, word int, nth int, label int, token string")
    judged = [(r.score >= 0.5, truth[r.doc_id]) for r in scan(df, labels).collect() if r.doc_id in truth and r.doc_id >= 200]
    assert sum(a == b for a, b in judged) / len(judged) > 0.95
    assert {r.score for r in scan(df, labels.where("label = 1")).collect()} == {1.0}
    assert {r.score for r in scan(df, labels.limit(0)).collect()} == {0.0}


def test_scan_after_an_observation(spark, spoken):
    """An observation leaves a manager in the session that cannot be sent to tasks."""
    df, _, _ = spoken
    seen = Observation("seen")
    df.observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == df.count()
    assert scan(df, review()).count() > 0


def test_short_and_letter_only_secrets_are_candidates(spark):
    texts = ['x password = "hunter2!" y', "pwd=S3cr3t", "api_key: abcdefghijklmnopqrstuvwx,", "'db_password': 'a:b@c'", "the token was secret and the key too"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit(None).cast("string"))
    found = {(r.id, r.candidate) for r in candidates(df).collect()}
    assert found == {(0, "hunter2!"), (1, "S3cr3t"), (2, "abcdefghijklmnopqrstuvwx"), (3, "a:b@c")}
    rows = featured(candidates(df), vocabulary(df)).collect()
    assert all(r.keyword_before == r.assigned == 1 for r in rows) and {r.id for r in rows if r.quoted} == {0, 3}


def test_two_copies_of_the_corpus_change_nothing(spoken):
    df, _, _ = spoken
    same = [Counter((r.doc_id, r.word, r.nth, r.candidate, round(r.score, 9)) for r in scan(rows, review()).collect()) for rows in (df, df.union(df))]
    assert same[0] == same[1] and len(same[0]) > 100


def test_no_rows(no_docs):
    assert scan(no_docs, review()).collect() == []


def test_query(spark, sf_dir):
    rows = op7_secret_scan(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens = {(i, m) for i, t in texts.items() for m in re.findall(r'token = "([0-9a-f]{40})"', t)}
    assert tokens and {(r.doc_id, r.candidate) for r in rows if r.is_secret} >= tokens
