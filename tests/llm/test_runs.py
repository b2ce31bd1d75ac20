"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from courtlake.llm import runs
from courtlake.llm.queries import QUERIES, planted_cycle


def brute_runs(words):
    """Every lag in turn."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(
                    q % d == 0 and all(words[x] == words[x + d] for x in range(i, i + size - d))
                    for d in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [] if text is None else text.encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


PIECE = st.one_of(
    st.lists(st.integers(0, 3), max_size=30),
    st.tuples(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.integers(2, 7)).map(lambda x: x[0] * x[1]),
    st.tuples(st.lists(st.integers(0, 1), min_size=1, max_size=20), st.integers(2, 9)).map(lambda x: x[0] * x[1]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECE, max_size=5), st.integers(0, 5))
def test_find_runs(pieces, cut):
    words = [w for p in pieces for w in p]
    words = words[:len(words) - cut]
    assert runs.find_runs(np.array(words, np.int64)) == brute_runs(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(PIECE, max_size=2).map(lambda p: [w for x in p for w in x]), max_size=6))
def test_texts_of_a_slice_stay_apart(lists):
    found = runs.runs_of([[b"%d" % w for w in words] for words in lists])
    assert found == [brute_runs(words) for words in lists]


def test_long_text():
    """One long period in a long text, and one word a million times."""
    words = np.arange(400_000)
    words[100_000:300_000] = 100_000 + np.arange(200_000) % 48_611
    assert runs.find_runs(words) == [(100_000, 200_000, 48_611)]
    assert runs.find_runs(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]


def cases():
    rng = np.random.default_rng(3)
    texts = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "x a b a b a b a b y", "a\x1ca\x1ca a a a a",
             "a b c " * 9, "é é é é é é é é é é", "ab " * 3000 + "c d " * 40]
    texts += [" ".join(f"w{i}" for i in rng.integers(0, 900, int(n))) for n in rng.integers(1, 400, 120)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, "a"), (3, "b " * 7)]


def test_query_against_brute_force(spark, tmp_path):
    rows = cases()
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    docs = spark.createDataFrame([(i, t, "x", [1]) for i, t in rows], "doc_id long, text string, runs string, words array<int>")
    docs.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(brute_row(*r)) for r in rows)


def test_operator_output(spark):
    docs = spark.createDataFrame([(None, "u v u v u v u v"), (1, "p " * 7 + "q")], "doc_id long, text string")
    found = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert found[None].runs == [(0, 8, 2)] and found[None].collapsed == "u v"
    assert found[1].runs == [(0, 7, 1)] and found[1].collapsed == "p q" and found[1].n_words == 8
    assert runs.periodic_runs(docs.limit(0)).count() == 0
    assert planted_cycle(None, [b"a"]) == [b"a"]
