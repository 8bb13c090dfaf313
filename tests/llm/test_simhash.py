import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rillflow.llm import graph
from rillflow.llm.graph import components
from rillflow.llm.queries import op1_simhash_near_dedup
from rillflow.llm.simhash import keep_one, links, masks, near_duplicates
from rillflow.workspace import land


def slow_fingerprint(text, shingle=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius):
    """Smallest id reachable, per row."""
    labels = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= radius and labels[i] != labels[j]:
                old, new = labels[i], labels[j]
                labels = [new if x == old else x for x in labels]
    ids = {label: min((r[0] for r, x in zip(rows, labels, strict=True) if x == label and r[0] is not None), default=None) for label in labels}
    return [ids[x] for x in labels]


def test_edge_rows_against_brute_force(docs, small_docs):
    rows = [(r[0], slow_fingerprint(r[1])) for r in small_docs]
    want = Counter((i, fp, c) for (i, fp), c in zip(rows, slow_components(rows, 4), strict=True))
    got = Counter((r.doc_id, r.fp0 % (1 << 64), r.component_id) for r in near_duplicates(docs).collect())
    assert got == want


def test_no_rows(no_docs):
    assert near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize(("radius", "parts"), [(1, 1), (4, 1), (9, 2), (11, 2)])
def test_masks_cover_every_pair(radius, parts):
    pick = random.Random(radius)
    for level in range(3):
        family = masks(radius, parts, level)
        for _ in range(2000):
            change = sum(1 << bit for bit in pick.sample(range(64), radius))
            assert any(change & mask == 0 for mask in family)
        assert all(mask.bit_count() >= 64 // parts // 2 - 6 for mask in family)


@pytest.mark.parametrize("bucket_rows", [1 << 16, 20])
def test_links_connect_a_crowded_ball(spark, bucket_rows):
    """Thousands of pairs in the same buckets, with chains that leave the first ball."""
    pick = random.Random(3)
    prints = {pick.getrandbits(64) for _ in range(50)}
    centre = pick.getrandbits(64)
    for _ in range(300):
        prints.add(centre ^ sum(1 << bit for bit in pick.sample(range(64), pick.randint(0, 6))))
    prints = [np.uint64(p).astype(np.int64).item() for p in prints]
    df = spark.createDataFrame([(p, p) for p in prints], "node long, fp0 long")
    found = {r.node: r.root for r in components(links(df, (4,), bucket_rows=bucket_rows)).collect()}
    want = slow_components([(p, p % (1 << 64)) for p in prints], 4)
    assert [found.get(p, p) for p in prints] == want


def test_rounds_over_few_edges_write_few_files(spark, monkeypatch):
    """A round of a few hundred edges is no file for each of many shuffle partitions; the components are the same."""
    tasks = []

    def noted(df, name, path=None):
        landed = land(df, name, path)
        tasks.append(len(landed.inputFiles()))
        return landed

    monkeypatch.setattr(graph, "land", noted)
    settings = {"spark.sql.shuffle.partitions": "20", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df = spark.createDataFrame([(k, k + 1) for k in range(300) if k % 100 != 99], "u long, v long")
        found = dict(components(df).collect())
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == {k: k // 100 * 100 for k in range(300)}
    assert len(tasks) > 2 and set(tasks[1:]) == {1}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    df = spark.createDataFrame([*chain, *star, (7, 7), (3, 2), (200, 201)], "u long, v long")
    found = dict(components(df.orderBy(F.rand(1))).collect())
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_large_radius_with_confirmation(docs, small_docs):
    found = {(r.doc_id, r.fp0): r.component_id for r in near_duplicates(docs, radius=9, shingle=5, parts=2, confirm=16).collect()}
    assert len(set(found.values())) > 25


def test_one_row_of_each_component_stays(docs, small_docs):
    rows = [(r[0], r[1]) for r in small_docs]
    labels = slow_components([(k, slow_fingerprint(t)) for k, (_, t) in enumerate(rows)], 4)
    best = {}
    for (i, text), label in zip(rows, labels, strict=True):
        rank = (i is None, i or 0, hashlib.md5((text or "").encode()).hexdigest())
        best[label] = min(best.get(label, rank), rank)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id is None, r.doc_id or 0, hashlib.md5((r.text or "").encode()).hexdigest()) for r in kept.collect())
    assert got == Counter(best.values())


def test_clashing_names(spark):
    rows = [(1, "a b c d e f", 1, 1, 1, 1), (2, "a b c d e f", 2, 2, 2, 2), (3, "one two three four", 3, 3, 3, 3)]
    clashing = spark.createDataFrame(rows, "doc_id long, text string, place int, told int, first int, row int")
    assert sorted(map(tuple, keep_one(clashing).collect())) == [rows[0], rows[2]]
    assert sorted(r.component_id for r in near_duplicates(clashing).collect()) == [1, 1, 3]


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    prints = {i: slow_fingerprint(t) for i, t in docs.items()}
    components_of = dict(zip(docs, slow_components(list(prints.items()), 4), strict=True))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op1_simhash_near_dedup(spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i]:016x}", components_of[i]) for i in docs}
