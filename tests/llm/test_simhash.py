"""SimHash groups against brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
import xxhash

from courtlake.llm import simhash
from courtlake.llm.components import components
from courtlake.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"


def fingerprint(text: str | None) -> int:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in WHITE:
            words, word = words + [word] if word else words, ""
        else:
            word += c
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    ids = sorted(rows)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if (rows[a] ^ rows[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (f"{rows[i]:016x}", find(i)) for i in ids}


def rows_of(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute({r.doc_id: fingerprint(r.text) for r in docs.collect()})
    assert rows_of(QUERIES["op3_simhash_near_dedup"](spark, sf_dir)) == expected


def test_covering():
    values = np.random.default_rng(1).integers(0, 2**63, 300).astype(np.uint64)
    for value, flips in zip(values, itertools.cycle([(), (3,), (5, 60), (63,), (0, 63), (7, 8)])):
        other = value
        for f in flips:
            other ^= np.uint64(1 << f)
        both = [set(simhash.anchors_of(np.array([v], np.uint64), 6)[1].tolist()) for v in (value, other)]
        assert both[0] & both[1]
        assert all((int(value) ^ a).bit_count() <= 2 for a in both[0])
        assert len(both[0]) in (2, 33)


@pytest.mark.parametrize("seed", [0, 1])
def test_dense_groups(spark, seed):
    """Fingerprints around a few centres: every link and no other counts."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 4)
    prints = {}
    for i in range(400):
        value = int(centres[i % 4])
        for f in rng.integers(0, 64, rng.integers(0, 4)):
            value ^= 1 << int(f)
        prints[i] = value
    df = spark.createDataFrame(
        [(i, bytearray(v.to_bytes(8, "little"))) for i, v in prints.items()], "rep long, sketch binary")
    kind = simhash.TWO_BITS
    distinct = df.groupBy("sketch").agg({"rep": "min"}).withColumnRenamed("min(rep)", "rep")
    links = simhash._links(simhash._anchor_rows(distinct, kind), kind)
    roots = {r.node: r.root for r in components(spark, links).collect()}
    least = {r.sketch: r.rep for r in distinct.collect()}
    found = {i: roots.get(r, r) for i, v in prints.items()
             for r in [least[v.to_bytes(8, "little")]]}
    assert found == {i: c for i, (_, c) in brute(prints).items()}


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", None), (4, "one", "x"), (5, "One", "x"),
            (5, "One", "x"), (None, "one", "x"), (None, "alone in the world", "x"),
            (6, "a b c " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = simhash.near_groups(spark, docs)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in found.collect())
    assert got == [(0, 0), (0, 4), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (6, 6)]
    assert simhash.near_groups(spark, docs.limit(0)).count() == 0
    kept = simhash.one_of_each(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 4, 6]


def test_similar_copies(spark):
    """Copies of five-word similarity 0.8 and more are found, unrelated texts stay."""
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(5000)]
    rows, planted = [], set()
    for i in range(60):
        words = [vocabulary[j] for j in rng.integers(0, 5000, 300)]
        rows.append((i, " ".join(words)))
        if i % 2:
            for j in rng.integers(0, 300, 5):
                words[j] = "changed" + str(i)
            rows.append((1000 + i, " ".join(words)))
            planted.add(1000 + i)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.one_of_each(spark, docs).collect()}
    assert {i for i in range(60)} <= kept
    assert len(planted & kept) <= 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (7, None), (3, 2), (2, 3), (1, 3)]
    found = components(spark, spark.createDataFrame(chain, "a long, b long"))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, 2: 1, 3: 1}
    assert found.count() == len(got)
    assert components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_pipeline_drops_near_copies_by_their_fingerprints(spark):
    """Two texts of one refrain with other endings: equal fingerprints, similarity below 0.8 over runs."""
    refrain = "we meet again " * 60
    docs = spark.createDataFrame([
        (1, refrain + "one two three four five six"), (2, refrain + "red green blue black white grey"),
        (3, "nothing of this is found in any other text here"), (None, refrain + "seven eight nine ten"),
    ], "doc_id long, text string")
    kept = simhash.one_of_each(spark, docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3]
