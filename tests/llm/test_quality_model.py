import zlib

import numpy as np

from rillflow.llm.quality_model import FEATURES, document_statistics, fit, held_out, quality_scores, statistics
from rillflow.llm.queries import op9_quality_classifier


def test_held_out_accuracy(spark, sf_dir):
    rows = op9_quality_classifier(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(judged) > 50 and np.mean([p == t for p, t in judged]) > 0.93


def test_densities_against_numpy(spark):
    pick = np.random.default_rng(1)
    x = np.concatenate((pick.normal(0, 1, (300, len(FEATURES))), pick.normal(0.6, 0.4, (200, len(FEATURES)))))
    y = np.repeat([0, 1], [300, 200])
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y, strict=True)], "x array<double>, label long")
    model = fit(rows.repartition(5), shrinkage=0.2, ridge=0.01)
    logs = []
    own = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled = np.diag(0.6 * np.diag(own[0]) + 0.4 * np.diag(own[1]))
    for k in (0, 1):
        cov = 0.8 * own[k] + 0.2 * pooled + 0.01 * np.eye(len(FEATURES))
        d = x - x[y == k].mean(axis=0)
        logs.append(np.log((y == k).mean()) - 0.5 * (np.linalg.slogdet(cov)[1] + (d @ np.linalg.inv(cov) * d).sum(axis=1)))
    want = 1 / (1 + np.exp(logs[0] - logs[1]))
    assert np.allclose(model.scores(x), want, atol=1e-9)


def test_edge_rows(spark, docs, small_docs):
    labels = spark.createDataFrame([(k, k % 2, "x", 1) for k in range(40)] + [(3, None, "x", 1), (4, 7, "x", 1), (None, 1, "x", 1), (5, 1, "x", 1)], "doc_id long, quality int, text string, label int")
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == len(small_docs)
    assert all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False, False]
    # Held-out labels make no difference.
    other = labels.where(~held_out(labels.doc_id))
    assert {(r.doc_id, r.score) for r in quality_scores(docs, other).collect()} == {(r.doc_id, r.score) for r in rows}


def test_one_class_none_and_no_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(k, 1) for k in (0, 1, 3)], "doc_id long, quality int")
    some = {r.score for r in quality_scores(docs, labels).collect()}
    assert len(some) == 1 and some.pop() > 0.5
    assert {r.score for r in quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(no_docs, labels).collect() == []


def test_statistics(docs):
    assert all(len(r.x) == len(FEATURES) and np.isfinite(r.x).all() for r in document_statistics(docs).collect())
    assert statistics(b"") == [0.0] * len(FEATURES)
    at = dict(zip(FEATURES, statistics(b"AB AB! cd1\ncd1\ncd1"), strict=True))
    assert np.isclose(at["upper"], np.arcsin(np.sqrt(4 / 14))) and np.isclose(at["repeated_lines"], np.arcsin(np.sqrt(1 / 3)))
