"""Compression classifier: held-out accuracy and odd input."""

from __future__ import annotations

import zlib

import numpy as np

from courtlake.llm import quality
from courtlake.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op9_compression_quality"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
              if rows[r.doc_id].held_out}
    right = [rows[i].predicted == q for i, q in labels.items()]
    assert len(right) > 400 and np.mean(right) > 0.97
    good = [rows[i].score for i, q in labels.items() if q == 1]
    bad = [rows[i].score for i, q in labels.items() if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(None, "plain words here", "x"), (1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "a b " * 200_000, "x"),
         *((i, "the cat sat on a mat and went home " * 3 + str(i), "x") for i in range(10, 40)),
         *((i, "$$$ ### BUY!! " * 9 + str(i), "x") for i in range(40, 70))],
        "doc_id long, text string, label string")
    labels = spark.createDataFrame(
        [(i, int(i < 40), 0) for i in range(10, 70)] + [(None, 1, 0), (5, None, 0), (10, 1, 0)],
        "doc_id long, quality int, toxic int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    scores = {r.doc_id: r.score for r in rows}
    assert min(scores[i] for i in range(10, 40)) > max(scores[i] for i in range(40, 70))
    again = {r.doc_id: r.score for r in quality.score(docs, quality.train(docs, labels)).collect()}
    assert again == scores
    one = quality.train(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.score(docs, one).collect()} == {1.0}
    none = quality.train(docs.limit(0), labels.limit(0))
    assert {r.score for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), quality.train(docs, labels)).count() == 0
