"""MinHash groups against brute force over all pairs."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from courtlake.llm import minhash
from courtlake.llm.queries import QUERIES


def shingles(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 4:
        return {b" ".join(words)}
    return {b" ".join(words[i:i + 4]) for i in range(len(words) - 3)}


def brute(rows):
    """``(doc_id, n, component, kept)`` of each row, and the number of links between different sets."""
    sets = [shingles(t) for _, t in rows]
    root, links = list(range(len(rows))), 0

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            links += sets[i] != sets[j]
            root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    found = []
    for i, (doc, _) in enumerate(rows):
        component = least.get(top(i)) if sets[i] else doc
        found.append((doc, len(sets[i]), component, doc == component))
    return sorted(map(repr, found)), links


def groups(spark, rows):
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, node int")
    found = minhash.minhash_groups(spark, docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(repr(tuple(r)) for r in found.collect())


def edited(rng, words, low, high):
    words = list(words)
    for j in rng.integers(0, len(words), int(rng.integers(low, high))):
        words[j] = f"z{int(rng.integers(9000))}"
    return words


def test_shingle_sets():
    for text in ("", "A", "a b c", "a b c d", "a b c d e", "a b a b a b a b", "É é x y z w"):
        assert len(minhash.shingle_set(text.encode())) == len(shingles(text))
    assert minhash.shingle_set(b"A b C").tolist() == minhash.shingle_set(b" a\tB c\n").tolist()
    assert minhash.shingle_set(b"a b").tolist() != minhash.shingle_set(b"b a").tolist()


def test_bins_agree_as_often_as_sets_do():
    """Densified bins too: small sets, each bin of its own chance."""
    rng = np.random.default_rng(1)
    for size in (4, 12, 60, 400):
        agree = []
        for _ in range(300):
            union = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) << np.uint64(1))
            extra = len(union) // 4
            left, right = union[rng.permutation(len(union))[extra:]], union
            agree.append((minhash.bins_of(np.sort(left)) == minhash.bins_of(right)).mean())
        assert abs(np.mean(agree) - (1 - extra / len(union))) < 0.02


def test_small_sets_are_found(spark):
    """Sets of four and five shingles: one in five differs."""
    rows = []
    for i in range(150):
        words = [f"w{i}-{j}" for j in range(8)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:7]))]
    expected, links = brute(rows)
    assert links == 150 and groups(spark, rows) == expected


def test_similarities_around_the_limit(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(150):
        words = [f"w{j}" for j in rng.integers(0, 5000, 300)]
        extra = [f"x{j}" for j in rng.integers(0, 5000, int(rng.integers(30, 90)))]
        other = edited(rng, words, 3, 20) if i % 3 else words + extra
        rows += [(i, " ".join(words)), (1000 + i, " ".join(other))]
    expected, links = brute(rows)
    assert 40 < links < 140
    assert groups(spark, rows) == expected


@pytest.mark.parametrize("cell", [7, 2000])
def test_large_group_of_chains(spark, monkeypatch, cell):
    """Copies with edits of their own: most links are not with the centre of a star."""
    rng = np.random.default_rng(7)
    base = [f"w{j}" for j in rng.integers(0, 5000, 200)]
    rows = [(500 + i, " ".join(edited(rng, base, 1, 9))) for i in range(140)]
    rows += [(900 + i, " ".join(edited(rng, base, 9, 14))) for i in range(40)]
    chain = [f"c{j}" for j in range(200)]
    for i in range(60):  # each text a few words on from the one before
        rows.append((2000 - i, " ".join(chain[i % 200:] + [f"d{i}-{j}" for j in range(i)])))
        chain[199 - i] = f"e{i}"
    expected, links = brute(rows)
    assert links > 1000
    monkeypatch.setattr(minhash, "CELL_ROWS", cell)
    monkeypatch.setattr(minhash, "BLOCK_PAIRS", 50)
    assert groups(spark, rows) == expected


def test_stars_bound_the_pairs(spark):
    """Candidates of a large group are a few a member, not all pairs."""
    rng = np.random.default_rng(8)
    base = [f"w{j}" for j in rng.integers(0, 5000, 300)]
    rows = [(i, " ".join(edited(rng, base, 1, 3))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = minhash._sketches(docs).withColumnRenamed("doc_id", "rep")
    stars = minhash._stars(spark, minhash._shared(spark, prints)).count()
    assert 399 <= stars < 400 * minhash.BANDS / 2


def test_odd_rows(spark):
    copies = [(9, "one two three four five six"), (9, "one two three four five six"), (9, "q w e r t"), (4, "ONE two\tthree four\nfive six")]
    rows = copies + [(None, "one two three four five six"), (None, "nothing like it at all"), (None, None), (7, None), (8, ""), (6, " \n"),
                     (3, "a"), (2, "A"), (1, "a b"), (10, "a b c"), (11, "word " * 30000), (12, "word word word word")]
    expected, _ = brute(rows)
    assert groups(spark, rows) == expected
    assert groups(spark, []) == []


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    expected, _ = brute(docs)
    found = QUERIES["op12_minhash_near_dedup"](spark, sf_dir)
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected


def test_bitmaps_go_with_shared_buckets_only(spark, monkeypatch):
    """Rows of all buckets are joined by bucket as two numbers; most buckets hold one set."""
    written, write = {}, minhash.saved
    monkeypatch.setattr(minhash, "saved", lambda s, df, name: written.setdefault(name, write(s, df, name)))
    rows = [(i, " ".join(f"w{j}" for j in range(30)) + f" x{i}") for i in range(3)] + [(9, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prints = minhash._sketches(docs).withColumnRenamed("doc_id", "rep")
    shared = minhash._shared(spark, prints)
    assert written["minhash-members"].columns == ["bucket", "node", "crowd"]
    sets = {r.node: (r.n, r.bits, r.buckets) for r in prints.collect()}
    crowds = {}
    for node, (_, _, buckets) in sets.items():
        for b in buckets:
            crowds.setdefault(b, []).append(node)
    expected = sorted((b, node, sets[node][0], sets[node][1], len(nodes))
                      for b, nodes in crowds.items() if len(nodes) > 1 for node in nodes)
    assert expected and sorted(tuple(r) for r in shared.collect()) == expected
