"""The pipeline and each of its stages against brute force."""

import re
from collections import Counter

import public_tokenizers
import pytest
from test_decontamination import slow as slow_items
from test_line_dedup import slow as slow_lines
from test_quality_rules import slow as slow_quality
from tokenizers import Tokenizer

import corpus_pipeline
from rillflow.llm.simhash import SEED, fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def slow_near(rows):
    """Rows that stay: the first of each component, by id and then digest of the text."""
    import hashlib

    def rank(k):
        i, text = rows[k]
        return (i is None, i or 0, hashlib.md5((text or "").encode()).hexdigest())

    prints = [fingerprint((t or "").encode(), 4, SEED) % (1 << 64) for _, t in rows]
    labels = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4 and labels[a] != labels[b]:
                old, new = labels[a], labels[b]
                labels = [new if x == old else x for x in labels]
    best = {}
    for k, label in enumerate(labels):
        if label not in best or rank(k) < rank(best[label]):
            best[label] = k
    return [rows[k] for k in best.values()]


def slow_pipeline(rows, items):
    rows = [r for r in rows if slow_quality(r[1])[-1]]
    rows = [(i, kept) for i, _, _, kept in slow_lines(rows, 3, 50) if kept is not None and re.search(r"[^\x20\x09-\x0D]", kept)]
    rows = slow_near(rows)
    dirty = slow_items(rows, items)[1]
    return [r for r in rows if r not in dirty]


def test_pipeline_against_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = slow_pipeline(rows, items)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == {i for i, _ in want} and 0 < len(want) < len(rows)
    for i, text in want:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and bytes(got[i].ids) == b"".join(x.to_bytes(4, "little") for x in ids) and got[i].decoded == text


@pytest.fixture(scope="module")
def plain(docs):
    """Edge rows with the columns of documents."""
    return docs.select(*COLUMNS)


def test_stages_on_edge_rows(spark, plain, small_docs, sf_dir):
    rows = [(r[0], r[1]) for r in small_docs]
    stages = dict(corpus_pipeline.STAGES)
    quality = stages["quality_rules"](spark, plain, sf_dir)
    lines = stages["line_dedup"](spark, plain, sf_dir)
    near = stages["simhash_near_dedup"](spark, plain, sf_dir)
    clean = stages["benchmark_decontamination"](spark, plain, sf_dir)
    for df in (quality, lines, near, clean):
        assert df.columns == COLUMNS
    assert Counter((r.doc_id, r.text) for r in quality.collect()) == Counter(r for r in rows if slow_quality(r[1])[-1])
    left = [(i, kept) for i, _, _, kept in slow_lines(rows, 3, 50) if kept is not None and re.search(r"[^\x20\x09-\x0D]", kept)]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lines.collect()) == Counter((i, t, len(t)) for i, t in left)
    # NULL and empty texts have one digest, so which of them stays among equal ids is open.
    assert Counter((r.doc_id, r.text or "") for r in near.collect()) == Counter((i, t or "") for i, t in slow_near(rows))
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(rows)
    assert len(stages["bpe"](spark, plain, sf_dir).collect()) == len(rows)


def test_stages_on_empty_tables(spark, no_docs, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs.select(*COLUMNS), sf_dir).collect() == []


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe"]
