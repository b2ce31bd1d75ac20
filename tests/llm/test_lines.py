"""Line dedup, its state, and the cuckoo filter."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from courtlake.llm import line_dedup as ld
from courtlake.llm.cuckoo import CuckooFilter
from courtlake.llm.queries import ORACLES, QUERIES
from courtlake.session import shared_dir
from harness.check import _rows, connect

WHITE = " \t\n\x0b\x0c\r"


def key_of(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))
    return line if len(line) >= 40 else None


def brute(rows, min_docs=5):
    holders = defaultdict(list)
    for n, (doc_id, text) in enumerate(rows):
        for key in {key_of(x) for x in (text or "").split("\n")} - {None}:
            holders[key].append(doc_id)
    last = {k: max((d for d in v if d is not None), default=None)
            for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in last or doc_id == last[key_of(x)]]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_whole_table(spark, scale):
    sf_dir = f"/root/testdata/{scale}"
    found = QUERIES["op2_cuckoo_line_dedup"](spark, sf_dir).toArrow()
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted((d, n, x, hashlib.sha256(t.encode()).hexdigest()) for d, n, x, t in brute(rows))
    assert sorted(zip(*(c.to_pylist() for c in found.columns))) == expected
    theirs = connect(sf_dir).sql(ORACLES["op2_cuckoo_line_dedup"]).to_arrow_table()
    assert _rows(found, sorted(found.column_names)) == _rows(theirs, sorted(found.column_names))


def odd_rows():
    a, b, c = ("a line that is long enough to be told from others %d" % i for i in range(3))
    rows = [(i, f"own text {i}\n {a.upper()}\t\nshort\n{b}\n{b}") for i in range(6)]
    rows += [(None, a), (None, a), (9, None), (10, ""), (11, "\n\n"), (2, c), (2, c), (2, c), (2, c), (2, c),
             (12, "é" * 39 + "\n" + "É" * 40), (13, f"{a}\r\n" + "x y " * 100_000)]
    return rows + [(20 + i, "É" * 40 + f"\n{a} and more of it") for i in range(5)]


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=repr)


def test_edge_cases(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(7, *r, "x") for r in rows], "n_lines int, doc_id long, text string, row string")
    found = ld.dedup_lines(spark, docs)
    assert result(found) == brute(rows)
    assert set(found.columns) == {"doc_id", "text", "row", "n_lines", "n_dropped"}
    assert [r.text for r in found.collect() if r.doc_id == 9] == [None]
    assert ld.dedup_lines(spark, docs.limit(0)).count() == 0


def test_increments_and_deletions(spark):
    """Counts, filters and results are those of the documents that are in, by whatever way."""
    rows = [r for r in odd_rows() if r[0] is not None]
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    state = ld.new_state(shared_dir(spark, "test-lines"), 100)
    state = ld.insert(spark, state, frame(rows[:8]))
    state = ld.insert(spark, state, frame(rows[8:]))
    gone = rows[3:6] + rows[-2:]
    state = ld.delete(spark, state, frame(gone))
    left = [r for r in rows if r not in gone]
    keys = ld.line_keys(frame(rows)).distinct()
    counts = {bytes(r.key): (r.n_docs, r.last_doc) for r in ld._counts(spark, state, keys).collect() if r.n_docs}
    expected = defaultdict(list)
    for r in ld.line_keys(frame(left)).collect():
        expected[bytes(r.key)].append(r.doc_id)
    assert counts == {k: (len(v), max(v)) for k, v in expected.items()}
    (data,) = [r.data for r in spark.read.parquet(state.folder("filters", 2)).collect()]
    kept = CuckooFilter(ld.SHARD_KEYS // 4, bytes(data))
    numbers = np.frombuffer(b"".join(sorted(counts)), np.uint64).reshape(-1, 2)
    assert kept.contains(numbers).all()
    assert sum(int((t != 0).sum()) for t in kept.tables) == len(counts)
    assert result(ld.drop_repeated(spark, state, frame(left), ld.line_keys(frame(left)))) == brute(left)
    state = ld.insert(spark, state, frame(gone))
    assert result(ld.drop_repeated(spark, state, frame(rows), ld.line_keys(frame(rows)))) == brute(rows)


def test_counts_are_compacted(spark, monkeypatch):
    monkeypatch.setattr(ld, "COMPACTED", 2)
    rows = [r for r in odd_rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    state = ld.insert_parts(spark, ld.new_state(shared_dir(spark, "test-lines"), 100), docs)
    assert (state.increments, state.base) == (3, 1)
    for part in range(ld.PARTS):
        state = ld.delete(spark, state, ld.of_part(docs, part))
    assert state.base == 5 and ld._all_counts(spark, state).count() == 0
    state = ld.insert_parts(spark, state, docs)
    pairs = ld.postings(spark, state, range(ld.PARTS))
    assert result(ld.drop_repeated(spark, state, docs, pairs)) == brute(rows)


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in odd_rows()],
                                 "doc_id long, text string, _row int, _gone_keys string, _DOC_ID int")
    found = ld.dedup_lines(spark, docs)
    assert result(found) == brute(odd_rows())
    assert {(r._row, r._gone_keys, r._DOC_ID) for r in found.collect()} == {(1, "x", 2)}


def test_deletion_takes_one_of_equal_fingerprints():
    keys = np.repeat(np.random.default_rng(1).integers(0, 2**63, (3, 2)).astype(np.uint64), 3, 0)
    kept = CuckooFilter(1 << 4)
    kept.insert(keys)
    kept.delete(keys[[0, 1, 3]])
    assert sum(int((t != 0).sum()) for t in kept.tables) == 6
    assert kept.contains(keys).all()


def test_cuckoo():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, (20_000, 2)).astype(np.uint64)
    kept = CuckooFilter(1 << 10)
    kept.insert(keys[:9_000])
    kept.insert(keys[9_000:10_000])
    assert kept.contains(keys[:10_000]).all()
    assert kept.contains(keys[10_000:]).mean() < 0.003 * len(kept.tables)
    kept = CuckooFilter(1 << 10, kept.to_bytes())
    kept.delete(keys[:5_000])
    assert kept.contains(keys[5_000:10_000]).all()
    assert kept.contains(keys[:5_000]).mean() < 0.02
    kept.delete(keys[5_000:10_000])
    assert not any(t.any() for t in kept.tables)
    assert not CuckooFilter(1 << 10).contains(keys[:3]).any()
