"""Near copies by similarity: all pairs whose sets of five-word runs have Jaccard 0.8 or more.

The pipeline adds the links of SimHash fingerprints (``simhash.py``) at most 2 of 64 bits apart.

All sets are put into one order, rare runs first. Of a set of n runs the first n - ceil(0.8 n) + 1
are its prefix; two sets of similarity 0.8 or more share a run of their prefixes, wherever they
differ. So sets meet at the runs of their prefixes, and nothing is lost before the exact check.
The order comes from ``COUNTERS`` counters of hashed runs over the whole corpus: any order gives the
same pairs, this one keeps common passages out of the prefixes.

First each set is compared with its neighbour by size at every run; verified links make components.
Then every pair of sets at a run that are not yet in one component is looked at, those that lengths,
places or a parity bitmap show to be below 0.8 go, and the rest is verified. A run that more than
``CELL_ROWS`` sets share is split into cells, each pair of cells is a group of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, ids_and_bytes, saved, text_slices
from courtlake.llm.components import components
from courtlake.llm.simhash import TWO_BITS, shingle_hashes, sketch_groups, sketch_of

WORDS = 5
#: Least similarity as a fraction: 4 / 5.
PART, WHOLE = 4, 5
COUNTERS, SLICES = 1 << 20, 64
#: Bits of the parity bitmap of a set.
BITS = 512
#: Sets of one cell of a run; a group holds two cells at most.
CELL_ROWS = 2000


def run_set(text: bytes) -> np.ndarray:
    """The different runs of a text, in order of their hashes."""
    return np.unique(shingle_hashes(text, WORDS, True)).view(np.int64)


def node_of(runs: np.ndarray) -> int:
    """One number for all texts of the same runs."""
    return int.from_bytes(hashlib.blake2b(runs.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_of(runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    n = len(runs)
    order = np.lexsort((runs, counts[runs & (COUNTERS - 1)]))
    return runs[order[:n - -(-PART * n // WHOLE) + 1]] if n else runs


def bitmap(runs: np.ndarray) -> bytes:
    """Parities of the runs at each bit: no more bits of two sets differ than runs are in one only."""
    odd = np.bincount((runs >> 32) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _nodes(docs: DataFrame) -> DataFrame:
    """``doc_id, node, sketch`` of every row; then, in rows with a ``slice``, the task's counts of runs."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("sketch", pa.binary()),
                        ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for part, texts in text_slices(batches):
            sets = [run_set(t) for t in texts]
            counts += np.bincount(np.concatenate(sets) & (COUNTERS - 1), minlength=COUNTERS).astype(np.uint32)
            yield arrow_batch(schema, doc_id=part.column("doc_id"), node=[node_of(s) for s in sets],
                              sketch=[sketch_of(t, TWO_BITS) for t in texts],
                              slice=pa.nulls(len(sets), pa.int32()), counts=pa.nulls(len(sets), pa.binary()))
        filled = [(i, c.tobytes()) for i, c in enumerate(counts.reshape(SLICES, -1)) if c.any()]
        yield arrow_batch(schema, doc_id=pa.nulls(len(filled), pa.int64()), node=pa.nulls(len(filled), pa.int64()),
                          sketch=pa.nulls(len(filled), pa.binary()), slice=[f[0] for f in filled], counts=[f[1] for f in filled])

    return ids_and_bytes(docs).mapInArrow(run, "doc_id long, node long, sketch binary, slice int, counts binary")


def _counts(nodes: DataFrame) -> np.ndarray:
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(c, np.uint32) for c in rows["counts"]], axis=0, dtype=np.uint32)
        return pd.DataFrame({"slice": rows["slice"].iloc[:1], "counts": [total.tobytes()]})

    counts = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for r in nodes.where("slice is not null").select("slice", "counts").groupBy("slice").applyInPandas(
            add, "slice int, counts binary").collect():
        counts[r.slice] = np.frombuffer(r.counts, np.uint32)
    return counts.ravel()


def _alike(spark: SparkSession, nodes: DataFrame) -> DataFrame:
    """``a, b``: a star of links for each group that the fingerprints make."""
    named = nodes.where("slice is null and doc_id is not null")
    own = saved(spark, named.select(F.col("node").alias("doc_id"), "sketch").distinct(), "similar-sketches")
    groups = sketch_groups(spark, own).where("doc_id <> component_id")
    return saved(spark, groups.select(
        F.col("component_id").alias("a"), F.col("doc_id").alias("b")).distinct(), "similar-alike")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays), pa.int64()))


def _prints(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """``node, n, prefix, bits, rep``: one row for each different set of runs."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int32()),
                        ("prefix", pa.list_(pa.int64())), ("bits", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            sets = [run_set(t) for t in texts]
            yield arrow_batch(schema, doc_id=part.column("doc_id"), node=[node_of(s) for s in sets],
                              n=[len(s) for s in sets], prefix=_lists([prefix_of(s, counts) for s in sets]),
                              bits=[bitmap(s) for s in sets])

    rows = ids_and_bytes(docs).mapInArrow(run, "doc_id long, node long, n int, prefix array<long>, bits binary")
    return rows.groupBy("node", "n", "prefix", "bits").agg(F.min("doc_id").alias("rep"))


def _possible(n: Column, pos: Column, other_n: Column, other_pos: Column) -> Column:
    """Whether sets of these lengths whose first shared run is at these places may reach 0.8."""
    return F.least(n - pos, other_n - other_pos) * (PART + WHOLE) >= (n + other_n) * PART


def _shared(prints: DataFrame) -> DataFrame:
    """``h, node, n, pos`` of prefix runs that two sets share, with the set before it in size."""
    rows = prints.select("node", "n", F.posexplode("prefix").alias("pos", "h"))
    by_size = Window.partitionBy("h").orderBy("n", "node")
    before = F.struct("node", "n", "pos")
    return rows.withColumn("before", F.lag(before).over(by_size)) \
        .withColumn("after", F.lead("node").over(by_size)) \
        .where("before is not null or after is not null").drop("after")


def _verified(spark: SparkSession, docs: DataFrame, prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets have similarity 0.8 or more, by all their runs."""
    schema = pa.schema([("node", pa.int64()), ("runs", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            sets = [run_set(t) for t in texts]
            yield arrow_batch(schema, node=[node_of(s) for s in sets], runs=_lists(sets))

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    needed = saved(spark, prints.join(ends, "node", "left_semi").select("node", "rep"), "similar-needed")
    texts = docs.join(needed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = ids_and_bytes(texts).mapInArrow(run, "node long, runs array<long>") \
        .join(needed.select("node"), "node", "left_semi").distinct()
    sets = saved(spark, sets, "similar-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("runs").alias("a_runs")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("runs").alias("b_runs")), "b")
    common, total = F.size(F.array_intersect("a_runs", "b_runs")), F.size("a_runs") + F.size("b_runs")
    return saved(spark, both.where(common * (PART + WHOLE) >= total * PART).select("a", "b"), "similar-links")


def _cells(shared: DataFrame, roots: DataFrame, prints: DataFrame) -> DataFrame:
    """Rows of the runs at which different components meet, each at all pairs of cells with its own."""
    rows = shared.select("h", "node", "n", "pos").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    mixed = rows.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size")) \
        .where("lo <> hi").select("h", F.ceil(F.col("size") / CELL_ROWS).cast("int").alias("cells"))
    return rows.join(mixed, "h").join(prints.select("node", "bits"), "node") \
        .withColumn("cell", F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))) \
        .select("h", F.least("cell", "other").alias("lo"), F.greatest("cell", "other").alias("hi"),
                "cell", "node", "n", "pos", "root", "bits")


def _pairs(cells: DataFrame) -> DataFrame:
    """``a, b``: pairs of different components that may have similarity 0.8."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("h", "lo", "hi", "cell", "node", "n", "pos", "root")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            keys = group_numbers(rest)
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group goes on
            if cut:
                yield from found(rest.slice(0, cut), keys[:cut])
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield from found(rest, group_numbers(rest))

    def group_numbers(batch: pa.RecordBatch) -> np.ndarray:
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "lo", "hi")]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return np.concatenate([[0], np.cumsum(new)]) if batch.num_rows else np.zeros(0, np.int64)

    def found(batch: pa.RecordBatch, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, lo, hi, cell, node, n, pos, root = (batch.column(c).to_numpy(zero_copy_only=False) for c in names)
        bits = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(len(key), -1)
        n, pos, step, rows = n.astype(np.int64), pos.astype(np.int64), 1, np.arange(len(key) - 1)
        while len(rows):
            rows = rows[rows + step < len(key)]
            rows = rows[key[rows] == key[rows + step]]
            a, b = rows, rows + step
            total = n[a] + n[b]
            near = (root[a] != root[b]) & ((lo[a] == hi[a]) | (cell[a] != cell[b]))
            near &= np.minimum(n[a] - pos[a], n[b] - pos[b]) * (PART + WHOLE) >= total * PART
            a, b, total = a[near], b[near], total[near]
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            near = apart * (PART + WHOLE) <= total * (WHOLE - PART)
            if near.any():
                a, b = node[a[near]], node[b[near]]
                yield arrow_batch(schema, a=pa.array(np.minimum(a, b)), b=pa.array(np.maximum(a, b)))
            step += 1

    return cells.repartition("h", "lo", "hi").sortWithinPartitions("h", "lo", "hi").mapInArrow(run, "a long, b long")


def similar_groups(spark: SparkSession, docs: DataFrame, fingerprints: bool = False) -> DataFrame:
    """``doc_id, component_id`` of every row of ``docs(doc_id, text)``.

    Links are pairs of similarity 0.8 or more; with ``fingerprints`` also those whose SimHash
    fingerprints are at most 2 bits apart. Nulls, blanks and repeated rows are treated as in
    ``simhash.near_groups``. A text of fewer than five words is one run.
    """
    nodes = saved(spark, _nodes(docs), "similar-nodes")
    own = nodes.where("slice is null").select("doc_id", "node")
    prints = saved(spark, _prints(docs, _counts(nodes)), "similar-prints")
    linked = prints.where("rep is not null")
    shared = saved(spark, _shared(linked), "similar-shared")
    before = F.col("before")
    first = saved(
        spark,
        shared.where(_possible(F.col("n"), F.col("pos"), before.n, before.pos)).select(
            F.least("node", before.node).alias("a"), F.greatest("node", before.node).alias("b")).distinct(),
        "similar-first")
    links = _verified(spark, docs, linked, first)
    if fingerprints:
        links = links.union(_alike(spark, nodes))
    roots = saved(spark, components(spark, links, "similar-components"), "similar-roots")
    rest = saved(
        spark,
        _pairs(_cells(shared, roots, linked)).distinct().join(first, ["a", "b"], "left_anti"), "similar-rest")
    links = links.union(_verified(spark, docs, linked, rest))
    roots = components(spark, links, "similar-components")
    rooted = saved(
        spark,
        prints.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")),
        "similar-rooted")
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return own.join(rooted.join(least, "root").select("node", "component_id"), "node").select("doc_id", "component_id")
