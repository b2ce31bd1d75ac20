"""Decontamination against brute force."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from courtlake.llm import decontaminate as dc
from courtlake.llm.queries import QUERIES


def statistics(texts):
    pairs = [Counter(dc.pairs_of(dc.words_of(t))) for t in texts]
    return dc.Statistics(len(texts), sum(map(lambda c: sum(c.values()), pairs)) / len(texts),
                         Counter(p for c in pairs for p in c))


def plain_scores(items, known):
    out = []
    for _, text in items:
        counts = Counter(dc.pairs_of(dc.words_of(text)))
        n = sum(counts.values())
        weights = {p: math.log(1 + (known.items - known.frequency[p] + .5) / (known.frequency[p] + .5))
                   * f * (dc.K1 + 1) / (f + dc.K1 * (1 - dc.B + dc.B * n / known.mean)) for p, f in counts.items()}
        out.append({p: w / sum(weights.values()) for p, w in weights.items()})
    return out


@pytest.mark.parametrize("least", [0.05, 0.3, 0.5])
def test_wand_finds_all(least):
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 20) % 30)) for i in range(150)]
    known = statistics([t for _, t in items])
    index, scores = dc.Index(items, known), plain_scores(items, known)
    for _ in range(60):
        words = [f"w{int(x)}" for x in rng.zipf(1.3, 60) % 30] + items[int(rng.integers(150))][1].split()[:15]
        held = set(dc.pairs_of(words))
        terms = index.terms(np.array([index.numbers.get(w, -1) for w in words]))
        got = dict(index.search(np.unique(terms[terms >= 0]).tolist(), least))
        every = {i: sum(w for p, w in s.items() if p in held) for i, s in enumerate(scores)}
        assert set(got) == {i for i, s in every.items() if s >= least - 1e-12}
        assert all(abs(got[i] - every[i]) < 1e-9 for i in got)


def test_planted_leaks(spark, sf_dir):
    """Every document that holds an item's words in a row is found, and no other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    expected = set()
    for d in docs:
        words = " " + " ".join(dc.words_of(d.text)) + " "
        expected |= {(d.doc_id, i.item_id) for i in items if f" {' '.join(dc.words_of(i.text))} " in words}
    found = QUERIES["op8_bm25_decontamination"](spark, sf_dir).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert len(found) == len(got) and expected and expected <= got
    assert len(got - expected) <= 1
    assert all(r.score >= 0.5 and min(r.question_overlap, r.answer_overlap) >= 0.7 for r in found)


def test_edge_cases(spark):
    item = "What is the tallest mountain of the small island? It is the grey one in the north."
    other = "Name the river that runs past the old mill"
    benchmark = spark.createDataFrame(
        [(1, item, 0), (1, item, 0), (2, None, 0), (3, "single", 0), (None, "no id here", 0), (4, other, 0), (5, "...", 0)],
        "item_id long, text string, start int")
    filler = " ".join(f"x{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, f"{filler} {item.upper()} {filler}"), (4, item[:45] + filler), (None, item),
         (5, f"{filler} {other.replace(' ', ' ### ')}"), (6, filler * 500 + " " + item), (3, filler), (7, "single")],
        "doc_id long, text string")
    rows = [(r.doc_id, r.item_id) for r in dc.leaks(spark, docs, benchmark).collect()]
    assert sorted(rows, key=repr) == sorted([(3, 1)] * 2 + [(None, 1)] * 2 + [(6, 1)] * 2 + [(5, 4)], key=repr)
    kept = dc.without_leaks(spark, docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 4, 7]
    assert dc.leaks(spark, docs.limit(0), benchmark).count() == 0
    assert dc.leaks(spark, docs, benchmark.limit(0)).count() == 0


def test_shards_agree(spark, sf_dir, monkeypatch):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.doc_id, r.item_id) for r in dc.leaks(spark, docs, items).collect()}
    monkeypatch.setattr(dc, "SHARD_ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(spark, docs, items).collect()} == whole


@pytest.mark.parametrize("space", [" ", "　", " ", " "])
def test_white_space_of_unicode(spark, space):
    """The same words between other spaces, in the item, the document or both, are the same text."""
    item = "What is the tallest mountain of the small island? It is the grey one in the north."
    filler = " ".join(f"x{i}" for i in range(40))
    other = item.replace(" ", space)
    docs = spark.createDataFrame([(1, f"{filler} {item} {filler}"), (2, f"{filler}{space}{other}"), (3, filler)], "doc_id long, text string")
    for text in (item, other):
        benchmark = spark.createDataFrame([(1, text)], "item_id long, text string")
        assert sorted(r.doc_id for r in dc.leaks(spark, docs, benchmark).collect()) == [1, 2]


@pytest.mark.parametrize("item", ["这座小岛上最高的山叫什么名字？北边那座灰色的山。", "この島で一番高い山は何ですか。北にある灰色の山です。",
                                  "ภูเขาที่สูงที่สุดบนเกาะเล็กคืออะไร ภูเขาสีเทาทางเหนือ"])
def test_scripts_without_spaces(spark, item):
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"前文{item}后文"), (2, "今天天气很好，我们去公园散步。" * 5), (3, f"some words {item[:4]} and more")], "doc_id long, text string")
    assert [r.doc_id for r in dc.leaks(spark, docs, benchmark).collect()] == [1]


def test_clashing_columns(spark):
    item = "which old harbour town lies on the northern shore of the long grey lake answer brindle haven"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"before it {item} and after", 5, 6), (2, "nothing of the kind here", 5, 6)],
                                 "doc_id long, text string, _row int, _LEAKED int")
    rows = dc.without_leaks(spark, docs, items).collect()
    assert [(r.doc_id, r._row, r._LEAKED) for r in rows] == [(2, 5, 6)]
