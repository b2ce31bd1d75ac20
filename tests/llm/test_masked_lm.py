"""Masked pseudo-likelihood: gradients, plain scoring, and what training learns."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from courtlake.llm import masked_lm as lm
from courtlake.llm.queries import QUERIES


def plain_log_probability(model, window, target):
    h = np.tanh(model.hidden + sum(model.embed[p][w] for p, w in enumerate(window)))
    group, own = divmod(target, lm.PER_CLASS)
    a = h @ model.classes + model.class_bias
    b = h @ model.words[group] + model.word_bias[group]
    return a[group] - np.log(np.exp(a).sum()) + b[own] - np.log(np.exp(b).sum())


def wide_model(seed=0):
    model = lm.Network.empty()
    model.flat[...] = np.random.default_rng(seed).normal(0, 0.3, len(model.flat))
    return model


def test_probabilities_sum_to_one_and_agree():
    model = wide_model()
    window = np.array([[3], [lm.PAD], [5], [900]])
    logs = model.log_probabilities(np.repeat(window, lm.SIZE, 1), np.arange(lm.SIZE))
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
    for t in (0, 31, 32, 1023):
        assert logs[t] == pytest.approx(plain_log_probability(model, window[:, 0], t), abs=1e-4)


def test_gradient():
    model, rng = wide_model(), np.random.default_rng(2)
    window, target = rng.integers(0, lm.SIZE + 1, (4, 50)), rng.integers(0, lm.SIZE, 50)
    window[0] = 7
    gradient = lm.Network.empty()
    model._forward(window, target, gradient)
    for i in np.flatnonzero(gradient.flat)[:: max(1, int((gradient.flat != 0).sum()) // 40)]:
        was, found = model.flat[i], []
        for step in (0.01, -0.01):
            model.flat[i] = was + step
            found.append(-model.log_probabilities(window, target).sum())
        model.flat[i] = was
        assert (found[0] - found[1]) / 0.02 == pytest.approx(float(gradient.flat[i]), abs=0.02)


def test_scores_follow_the_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words, flat = lm.train(spark, docs)
    model, known = lm.Network(flat.copy()), {w: i for i, w in enumerate(words.words)}
    found = {r.doc_id: r for r in lm.score(docs.union(docs.limit(3)), words, flat).collect()}
    exact = Counter(w for r in docs.collect() for w in (r.text or "").encode().lower().split())
    assert {bytes(r.word): r.n for r in words.counted.collect()} == exact
    for row in docs.orderBy("doc_id").limit(4).collect():
        numbers = [lm.word_number(w, known) for w in row.text.encode().lower().split()]
        padded = [lm.PAD] * 2 + numbers + [lm.PAD] * 2
        all_words = row.text.encode().lower().split()
        total = sum(np.log(exact[w] / words.counts[n]) for w, n in zip(all_words, numbers) if n >= lm.WORDS)
        total += sum(plain_log_probability(model, [padded[i + 2 + o] for o in lm.WINDOW], n)
                    for i, n in enumerate(numbers))
        assert found[row.doc_id].n_tokens == len(numbers)
        assert found[row.doc_id].log_prob == pytest.approx(total, rel=1e-4)
        assert found[row.doc_id].mean_log_prob == pytest.approx(total / len(numbers), rel=1e-4)
    counts = {}
    for row in docs.collect():
        for w in row.text.encode().lower().split():
            counts[lm.word_number(w, known)] = counts.get(lm.word_number(w, known), 0) + 1
    assert {i: n for i, n in enumerate(words.counts) if n} == counts


def test_learns_from_both_sides(spark):
    """Words in their order score above the same words out of order, and above their frequencies."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    cycle = " ".join(["alpha beta gamma delta epsilon zeta"] * 40)
    own = spark.createDataFrame([(10**6 + i, cycle) for i in range(300)], "doc_id long, text string")
    words, flat = lm.train(spark, docs.union(own))
    start = lm.Network.start(words.counts).flat
    mean = lambda d, m: {r.doc_id: r.mean_log_prob for r in lm.score(d, words, m).collect()}
    before, after = mean(docs, start), mean(docs, flat)
    assert np.mean(list(after.values())) > np.mean(list(before.values()))
    mixed = spark.createDataFrame([(1, cycle), (2, " ".join(sorted(cycle.split())))], "doc_id long, text string")
    scores = mean(mixed, flat)
    assert scores[1] > scores[2]


def test_words():
    texts = [b" A b\tA\n", b"", b"\x0b\x0c\r", "é\u00a0É \x1cx".encode(), b"b" * 100_000]
    words, codes, document = lm._words(texts)
    names = words.to_pylist()
    split = [t.lower().split() for t in texts]
    assert [names[c] for c in codes] == [w for own in split for w in own]
    assert document.tolist() == [i for i, own in enumerate(split) for _ in own]
    table = lm._table(words, pa.array([b"b"], pa.large_binary()))
    assert [int(n) for n in table] == [lm.word_number(w, {b"b": 0}) for w in names]


def test_a_word_of_its_own(spark):
    """Of two words in one bucket the one seen more often is likelier; an unseen one is least likely."""
    by_bucket = {}
    for i in range(2000):
        by_bucket.setdefault(lm.word_number(b"w%d" % i, {}), []).append(f"w{i}")
    often, seldom, unseen = next(iter(by_bucket.values()))[:3]
    frequent = " ".join(f"f{i} f{i} f{i} f{i} f{i} f{i}" for i in range(lm.WORDS))
    docs = spark.createDataFrame([(1, frequent), (2, f"{often} {often} {often} {seldom}")], "doc_id long, text string")
    words, flat = lm.train(spark, docs)
    asked = spark.createDataFrame([(1, often), (2, seldom), (3, unseen)], "doc_id long, text string")
    found = {r.doc_id: r.log_prob for r in lm.score(asked, words, flat).collect()}
    assert found[1] - found[2] == pytest.approx(np.log(3), abs=1e-9)
    assert found[3] - found[2] == pytest.approx(np.log(4 / 5), abs=1e-9)


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (2, "", 0), (None, "one", 0), (3, "one two " * 60_000, 0)],
        "doc_id long, text string, n_tokens int")
    words, flat = lm.train(spark, docs)
    rows = sorted(lm.score(docs, words, flat).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    assert [(r.doc_id, r.n_tokens) for r in rows] == [(None, 1), (1, 0), (2, 0), (2, 0), (3, 120_000)]
    assert [(r.log_prob, r.mean_log_prob) for r in rows[1:4]] == [(0.0, None)] * 3
    empty = docs.limit(0)
    assert lm.score(empty, *lm.train(spark, empty)).count() == 0


def test_query(spark, sf_dir):
    rows = QUERIES["op4_masked_pseudo_likelihood"](spark, sf_dir).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 200
    assert all(r.log_prob <= 0 for r in rows)
