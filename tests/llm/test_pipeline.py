"""The pipeline: each stage against a plain version of it, on its own input."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from courtlake.llm import decontaminate, quality, simhash
from test_lines import brute as plain_lines
from test_tokens import check_packed


def table(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.saved(spark, stage(spark, results[-1], sf_dir), "test-stage")
        results.append(path)
    for df in results[1:-1]:
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    raw, good, lines, single, clean = map(table, results[:-1])

    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert good == {i: t for i, t in raw.items() if scores[i] >= quality.THRESHOLD}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert sum(i in good for i, q in labels.items() if q) > 0.9 * sum(labels.values())

    assert lines == {i: t for i, _, _, t in plain_lines(list(good.items()))}
    chars = {r.doc_id: r.n_chars for r in results[2].collect()}
    assert all(chars[i] == len(t) for i, t in lines.items() if t != good[i])

    sets = {i: set(zip(*[t.lower().split()[k:] for k in range(5)])) for i, t in lines.items()}
    holders = defaultdict(list)
    for i, t in lines.items():
        holders[t].append(i)
    for same in holders.values():  # of exact copies the smallest stays at most
        assert not any(i in single for i in sorted(same)[1:])
    gone = set(lines) - set(single)
    for i in gone:  # what goes resembles something that was there
        assert any(j != i and (lines[j] == lines[i] or len(sets[i] & sets[j]) > 0.6 * len(sets[i] | sets[j])) for j in lines)
    pairs = [(i, j) for i in lines for j in lines if i < j and len(sets[i]) > 20 and len(sets[j]) > 20
             and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert all(not (i in single and j in single) for i, j in pairs)

    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = lambda t: any(f" {' '.join(decontaminate.words_of(x))} " in f" {' '.join(decontaminate.words_of(t))} " for x in items)
    assert not any(held(t) for t in clean.values())
    assert len(clean) >= sum(not held(t) for t in single.values()) - 1
    check_packed(results[-1].collect(), list(clean.items()))


def test_run(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "piece", "sequence_id", "offset", "ids"} <= set(rows.columns) and rows.count() > 20


def test_odd_documents(spark, sf_dir):
    docs = spark.createDataFrame(
        [(1, None, "en", None, None, 1), (2, "", "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (None, "some words here", None, None, 3, 1),
         (3, "many words " * 30_000, "en", "s", 4, 1), (3, "many words " * 30_000, "en", "s", 4, 1)],
        "doc_id long, text string, lang string, source string, n_chars long, component_id int")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, sf_dir)
            if name != "best-fit packing":
                assert out.columns == docs.columns, name
            out.collect()
    assert simhash.one_of_each(spark, docs).count() < docs.count()
