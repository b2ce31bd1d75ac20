"""The prefix trie against a trie of Python dictionaries."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from courtlake.llm import trie
from courtlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth int, node string"


def sequences(rows):
    """Turns of each conversation in order."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}


def rebuilt(own):
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return found


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    return sorted(repr((
        own[0], len(path), members[path[:-1]][0] if path else None, len(own), children[path], leaves[path],
        saved[path], hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
    )) for path, own in members.items())


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, None)[:6] for r in rows], SCHEMA)


def found_trie(spark, rows, shared=False):
    turns = trie.number_turns(spark, frame(spark, rows).repartition(3))
    ids = turns.select("conv_id").distinct()
    if shared:
        turns, ids = trie.with_shared_openings(spark, turns)
    found = trie.prefix_trie(spark, turns, ids)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                             "saved_tokens", "ends_sha256"]
    assert set(dict(found.dtypes).values()) == {"bigint", "string"}
    return sorted(repr(tuple(r)) for r in found.collect())


ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3)),
                st.sampled_from([None, "", "u"]), st.sampled_from([None, "", "x", "yy", "é😀"]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=40))
def test_random_turns(spark, rows):
    assert found_trie(spark, rows) == brute(sequences(rows))


def test_deep_and_wide(spark):
    """Two copies of a long conversation, a common opening, branches at all depths."""
    rows = [(c, t, "user", f"t{t}") for c in (700, 7) for t in range(133)]
    for c in range(20, 90):
        cut = c % 37
        rows += [(c, t, "user", f"t{t}") for t in range(cut)]
        rows += [(c, cut + t, "bot", "ab" * (t % 3)) for t in range(c % 5)]
    rows += [(1000 + c, 0, "user", "t0") for c in range(300)]
    convs = sequences(rows)
    assert found_trie(spark, rows) == brute(convs)


def test_shared_openings(spark):
    """Absent and short sources, conversations that lose all turns, a source of its own."""
    rows = [(c, t, "user", f"{c % 3}{t}") for c in [0, *range(3, 40), *range(200, 230), *range(501, 530), -5, -100]
            for t in range(1 + c % 9)]
    rows += [(200, t, None, None) for t in range(2)]
    convs = rebuilt(sequences(rows))
    assert any(not turns for turns in convs.values())
    assert found_trie(spark, rows, shared=True) == brute(convs)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (5, None, "user", "first"), (5, 1, None, None), (5, 1, None, None),
            (6, None, "user", "first"), (6, 1, "", ""), (2, 0, "user", "long" * 20000), (8, 0, "user", "long" * 20000)]
    assert found_trie(spark, rows) == brute(sequences(rows))
    assert found_trie(spark, [(3, 0, "a", "b")]) == brute({3: [("a", "b")]})
    assert found_trie(spark, []) == [] and found_trie(spark, [(None, 0, "a", "b")]) == []


def test_only_turnless(spark):
    """Every conversation loses its turns: the root is the only node, and a leaf."""
    ids = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1]
    rows = [(c, 0, "user", "x") for c in ids]
    assert found_trie(spark, rows, shared=True) == brute({c: [] for c in ids})


@pytest.mark.parametrize("ids", [[(1, 0, 5)], [(1, 0, c) for c in range(3000)] + [(2, 0, 4), (1, 7, 2)]])
def test_digests_of_many_ends(spark, ids):
    """Chunks of several sorted tasks make the digest of the whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = trie._digests(spark.createDataFrame(ids, "node long, pos long, conv_id long").repartition(4)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    groups = defaultdict(list)
    for node, pos, conv in ids:
        groups[node, pos].append(conv)
    assert {(r.node, r.pos): r.ends_sha256 for r in found} == {
        k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in groups.items()}


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    found = QUERIES["op13_prefix_trie"](spark, sf_dir)
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(rebuilt(sequences(rows)))
