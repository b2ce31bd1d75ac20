"""Near-duplicate groups by one-permutation MinHash, banded buckets and stars.

A text is the set of its different four-word shingles, as 64-bit hashes. One pass over the sorted
set fills ``BINS`` bins with their smallest hashes (one permutation hashing); an empty bin takes the
value of the first filled bin in a random order of its own (optimal densification), so that any bin
of two sets agrees with the probability of their similarity, small sets included. ``BANDS`` bands of
three bins make buckets: sets of similarity 0.8 miss all of them with probability
(1 - 0.8^3)^32 = 1e-10.

A bucket makes a star, not pairs: every member is compared with one centre, the member that shares most
buckets with others. Centres repeat across bands, so a set has few different candidates. Lengths and
a parity bitmap drop pairs that can't reach 0.8; links are confirmed on the full sets. What stars can
miss is a link between two members that are both below 0.8 to the centre. So the buckets where
different components still meet are looked at once more: members outside the largest component
there meet all members of other components, in cells of bounded size; pairs that lengths and
bitmap let pass and that weren't compared before are confirmed like the others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, ids_and_bytes, saved, text_slices
from courtlake.llm.components import components

WORDS, SEED = 4, 12
#: Least similarity as a fraction: 80 / 100.
PART, WHOLE = 4, 5
BANDS, ROWS = 32, 3
BINS = BANDS * ROWS
#: 64-bit words of the parity bitmap of a set.
LANES = 8
#: Members of one cell of a bucket; a group of cells holds two at most.
CELL_ROWS = 2000
#: Pairs that a task compares at once.
BLOCK_PAIRS = 1 << 20

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mixed(left: np.ndarray, right) -> np.ndarray:
    found = (left ^ (left >> np.uint64(31))) * _ODD[0] + right
    found = (found ^ (found >> np.uint64(30))) * _ODD[1]
    return found ^ (found >> np.uint64(32))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted hashes of the different shingles; fewer words are one shingle, none gives none."""
    words = text.lower().split()
    n, digest = len(words), xxhash.xxh64_intdigest
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter((digest(w, SEED) for w in words), np.uint64, n)
    size = min(WORDS, n)
    found = hashes[:n - size + 1]
    for i in range(1, size):
        found = _mixed(found, hashes[i:n - size + 1 + i])
    return np.unique(_mixed(found, np.uint64(size)))


def _probes() -> np.ndarray:
    """For each bin itself, then all others in a random order: where it looks for a value."""
    order = np.random.default_rng(SEED).random((BINS, BINS))
    np.fill_diagonal(order, -1)
    return np.argsort(order, axis=1)


_PROBES = _probes()
_ROWS_OF_BINS = np.arange(BINS)
_BAND = np.arange(BANDS, dtype=np.uint64)


def bins_of(hashes: np.ndarray) -> np.ndarray:
    """The densified bins of a non-empty sorted set."""
    place = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    filled, values = np.zeros(BINS, bool), np.zeros(BINS, np.uint64)
    filled[place[first]] = True
    values[place[first]] = hashes[first]
    donor = _PROBES[_ROWS_OF_BINS, filled[_PROBES].argmax(axis=1)]
    return values[donor]


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    """One bucket for each band; none for an empty set."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    bins = bins_of(hashes).reshape(BANDS, ROWS)
    found = _mixed(bins[:, 0], _BAND)
    for i in range(1, ROWS):
        found = _mixed(found, bins[:, i])
    return found.view(np.int64)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Parities of the hashes at each bit: of two sets no more bits differ than hashes are in one only."""
    odd = np.bincount((hashes & np.uint64(64 * LANES - 1)).astype(np.int64), minlength=64 * LANES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def node_of(hashes: np.ndarray) -> int:
    """One 64-bit number for all texts of the same set."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays).view(np.int64)))


def _sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, node, n, bits, buckets`` of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()),
                        ("bits", pa.list_(pa.int64())), ("buckets", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            sets = [shingle_set(t) for t in texts]
            yield arrow_batch(schema, doc_id=part.column("doc_id"), node=[node_of(s) for s in sets],
                              n=[len(s) for s in sets], bits=_lists([bitmap(s) for s in sets]),
                              buckets=_lists([buckets_of(s) for s in sets]))

    return ids_and_bytes(docs).mapInArrow(
        run, "doc_id long, node long, n long, bits array<long>, buckets array<long>")


def _possible(n: Column, bits: Column, other_n: Column, other_bits: Column) -> Column:
    """Whether sets of these sizes and bitmaps may reach the similarity."""
    apart = sum(F.bit_count(bits[i].bitwiseXOR(other_bits[i])) for i in range(LANES))
    sizes = F.least(n, other_n) * WHOLE >= F.greatest(n, other_n) * PART
    return sizes & (apart * (PART + WHOLE) <= (n + other_n) * (WHOLE - PART))


def _shared(spark: SparkSession, prints: DataFrame) -> DataFrame:
    """``bucket, node, n, bits, crowd`` of buckets that more than one set is in.

    Most buckets hold one set; sizes and bitmaps, nearly all bytes of a row, are joined to the others only.
    """
    rows = prints.select(F.explode("buckets").alias("bucket"), "node")
    crowds = saved(
        spark,
        rows.groupBy("bucket").agg(F.count("*").alias("crowd")).where("crowd > 1"), "minhash-crowds")
    members = saved(spark, rows.join(crowds, "bucket"), "minhash-members")
    return saved(spark, members.join(prints.select("node", "n", "bits"), "node").select(
        "bucket", "node", "n", "bits", "crowd"), "minhash-shared")


def _stars(spark: SparkSession, shared: DataFrame) -> DataFrame:
    """``a, b``: every member of a bucket beside the bucket's centre, where 0.8 is possible."""
    fame = saved(spark, shared.groupBy("node").agg(F.sum("crowd").alias("fame")), "minhash-fame")
    centres = saved(
        spark,
        shared.join(fame, "node").groupBy("bucket").agg(
            F.max(F.struct("fame", "node", "n", "bits")).alias("centre")),
        "minhash-centres")
    centre = F.col("centre")
    near = (F.col("node") != centre["node"]) & _possible(F.col("n"), F.col("bits"), centre["n"], centre["bits"])
    ends = F.least("node", centre["node"]), F.greatest("node", centre["node"])
    return shared.join(centres, "bucket").where(near).select(
        ends[0].alias("a"), ends[1].alias("b")).distinct()


def _confirmed(spark: SparkSession, docs: DataFrame, prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets have the similarity."""
    schema = pa.schema([("node", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches):
            sets = [shingle_set(t) for t in texts]
            yield arrow_batch(schema, node=[node_of(s) for s in sets], hashes=_lists(sets))

    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = saved(spark, prints.join(ends, "node", "left_semi").select("node", "rep"), "minhash-wanted")
    texts = docs.select("doc_id", "text").join(
        wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    # A repeated doc_id may bring other sets and the same set twice.
    sets = ids_and_bytes(texts).mapInArrow(run, "node long, hashes array<long>").join(
        wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])
    sets = saved(spark, sets, "minhash-sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("of_a")), "a") \
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("of_b")), "b")
    common, total = F.size(F.array_intersect("of_a", "of_b")), F.size("of_a") + F.size("of_b")
    return saved(spark, both.where(common * (PART + WHOLE) >= total * PART).select("a", "b"), "minhash-links")


def _cells(spark: SparkSession, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets where components meet, each in all groups of cells it belongs to.

    The largest component of a bucket (``outer`` cells) meets the others only; the others
    (``inner`` cells) also meet one another. A group is a pair of cells ``hi, lo``.
    """
    rows = shared.select("bucket", "node", "n", "bits").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    parts = rows.groupBy("bucket", "root").agg(F.count("*").alias("size"))
    cells = F.ceil((F.col("total") - F.col("largest.size")) / CELL_ROWS).cast("int")
    mixed = parts.groupBy("bucket").agg(
        F.max(F.struct("size", "root")).alias("largest"), F.sum("size").alias("total"),
        F.count("*").alias("parts")).where("parts > 1").select(
        "bucket", F.col("largest.root").alias("main"), cells.alias("inner"),
        F.ceil(F.col("largest.size") / CELL_ROWS).cast("int").alias("outer"))
    mixed = saved(spark, mixed, "minhash-mixed")
    outside = F.col("root") == F.col("main")
    own = F.when(outside, F.col("inner") + F.pmod(F.xxhash64("node"), F.col("outer"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("inner"))).cast("int")
    others = F.sequence(F.lit(0), F.col("inner") - 1 + F.when(outside, 0).otherwise(F.col("outer")))
    return rows.join(mixed, "bucket").withColumn("cell", own).withColumn("other", F.explode(others)).select(
        "bucket", F.greatest("cell", "other").alias("hi"), F.least("cell", "other").alias("lo"),
        "cell", "node", "n", "root", "bits")


def _rest(cells: DataFrame) -> DataFrame:
    """``a, b``: pairs of different components in a group of cells that may have the similarity."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            bounds = edges(rest)
            for lo, hi in zip(bounds[:-2], bounds[1:-1]):  # the last group goes on
                yield from found(rest.slice(lo, hi - lo))
            rest = rest.slice(bounds[-2]) if len(bounds) > 1 else rest
        if rest is not None and rest.num_rows:
            yield from found(rest)

    def edges(batch: pa.RecordBatch) -> list[int]:
        if not batch.num_rows:
            return [0]
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "hi", "lo")]
        new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]

    def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        order = np.argsort(batch.column("root").to_numpy(zero_copy_only=False), kind="stable")
        node, n, root, cell = (batch.column(c).to_numpy(zero_copy_only=False)[order]
                               for c in ("node", "n", "root", "cell"))
        bits = batch.column("bits").flatten().to_numpy(zero_copy_only=False)
        bits = bits.view(np.uint64).reshape(-1, LANES)[order]  # of a negative number numpy counts other bits
        one = batch.column("hi")[0] == batch.column("lo")[0]
        after = np.searchsorted(root, root, "right")  # rows of equal root end here
        at = 0
        while at < len(node) and after[at] < len(node):
            others = np.arange(after[at], len(node))
            last = min(after[at], at + max(1, BLOCK_PAIRS // len(others)))
            rows = np.arange(at, last)
            small, large = np.minimum.outer(n[rows], n[others]), np.maximum.outer(n[rows], n[others])
            near = small * WHOLE >= large * PART
            if not one:
                near &= cell[rows][:, None] != cell[others]
            i, j = np.nonzero(near)
            i, j = rows[i], others[j]
            apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
            near = apart * (PART + WHOLE) <= (n[i] + n[j]) * (WHOLE - PART)
            if near.any():
                a, b = node[i[near]], node[j[near]]
                yield arrow_batch(schema, a=pa.array(np.minimum(a, b)), b=pa.array(np.maximum(a, b)))
            at = last

    return cells.repartition("bucket", "hi", "lo").sortWithinPartitions("bucket", "hi", "lo").mapInArrow(
        run, "a long, b long")


def minhash_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links of similarity 0.8 or more, the row's
    own included; ``kept`` tells whether it is the row's own. Null, empty and blank texts have no
    shingles and are linked with nothing. Repeated rows stay, with the same set and so the same group. A
    null doc_id never names a group: it gets the smallest id of its group, or null, and is kept
    only then. Extra columns are left behind; an empty table gives an empty one.
    """
    own = saved(spark, _sketches(docs), "minhash-sketches")
    prints = saved(
        spark,
        own.where("n > 0").groupBy("node", "n", "bits", "buckets").agg(F.min("doc_id").alias("rep"))
        .where("rep is not null"),
        "minhash-prints")
    shared = _shared(spark, prints)
    stars = saved(spark, _stars(spark, shared), "minhash-stars")
    links = _confirmed(spark, docs, prints, stars)
    roots = saved(spark, components(spark, links, "minhash-components"), "minhash-roots")
    rest = _rest(_cells(spark, shared, roots)).distinct().join(stars, ["a", "b"], "left_anti")
    links = links.union(_confirmed(spark, docs, prints, saved(spark, rest, "minhash-rest")))
    roots = components(spark, links, "minhash-components")
    rooted = saved(
        spark,
        prints.join(roots, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")),
        "minhash-rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "root").select(
        "node", "component_id")
    found = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return own.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"),
        F.col("doc_id").eqNullSafe(found).alias("kept"))
