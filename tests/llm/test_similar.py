"""Near copies by similarity against brute force."""

from __future__ import annotations

import itertools

import numpy as np
import pytest

from courtlake.llm import similar, simhash


def groups(rows):
    """Components of all pairs of similarity 0.8 or more."""
    sets = {i: set(similar.run_set(t.encode()).tolist()) for i, t in rows}
    root = {i: i for i in sets}
    links = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links.add((a, b))
            x, y = sorted((root[a], root[b]))
            root = {i: x if r == y else r for i, r in root.items()}
    return root, links


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.component_id for r in similar.similar_groups(spark, docs).collect()}


def texts(seed, n, words=300):
    rng = np.random.default_rng(seed)
    return rng, [[f"w{j}" for j in rng.integers(0, 5000, words)] for _ in range(n)]


def test_contiguous_differences(spark):
    """Appended, removed, moved and changed passages: every pair of 0.8 or more is linked."""
    rng, bases = texts(5, 120)
    rows = []
    for i, words in enumerate(bases):
        extra = [f"x{j}" for j in rng.integers(0, 5000, int(rng.integers(30, 80)))]
        cut = int(rng.integers(30, 60))
        at = int(rng.integers(0, 200))
        other = [words + extra, extra + words, words[:at] + words[at + cut:], words[cut:] + words[:cut]][i % 4]
        rows += [(i, " ".join(words)), (1000 + i, " ".join(other))]
    expected, links = groups(rows)
    assert len(links) > 80
    assert found(spark, rows) == expected
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in simhash.one_of_each(spark, docs).collect()}
    assert kept == set(expected.values())


def test_below_the_limit_stays(spark):
    """Similarity from 0.5 to 0.95 by scattered changes: only chains of true links are groups."""
    rng, bases = texts(6, 150)
    rows = []
    for i, words in enumerate(bases):
        other = list(words)
        for j in rng.integers(0, 300, int(rng.integers(3, 17))):
            other[j] = f"y{int(rng.integers(5000))}"
        rows += [(i, " ".join(words)), (1000 + i, " ".join(other))]
    expected, links = groups(rows)
    assert 20 < len(links) < 130
    assert found(spark, rows) == expected


def test_cells(spark, monkeypatch):
    """Many copies with edits of their own, and texts that share a passage: small groups, same result."""
    rng, bases = texts(7, 61)
    rows = [(i, " ".join(bases[60][:40] + w[:9])) for i, w in enumerate(bases[:60])]
    for i in range(200):
        words = list(bases[60])
        for j in rng.integers(0, 300, int(rng.integers(1, 12))):
            words[j] = f"z{int(rng.integers(5000))}"
        rows.append((1000 + i, " ".join(words)))
    expected, links = groups(rows)
    monkeypatch.setattr(similar, "CELL_ROWS", 10)
    sizes, plain = [], similar._cells

    def seen(*args):
        cells = plain(*args)
        sizes.extend(r["count"] for r in cells.groupBy("h", "lo", "hi").count().collect())
        return cells

    monkeypatch.setattr(similar, "_cells", seen)
    assert found(spark, rows) == expected
    assert len(links) > 1000 and 0 < max(sizes) <= 50
