"""SimHash near-duplicates by anchor points of a covering code.

The anchors are the words of a Hamming code of length 2^m - 1 with one free bit beside it. Its
covering radius is 1: every word has an anchor at distance 1 or less. Two fingerprints that differ
in at most 2 bits have a word halfway between them, at most 1 bit from either; the anchor that
covers this word is at most 2 bits from both. So a fingerprint is replicated to all anchors within
2 bits (2 or 33 of them for 64 bits), and linked fingerprints always meet. Distinct 64-bit
fingerprints within 2 bits of an anchor are 2,081 at most, which bounds every group whatever the
data; exact copies are merged before.

Links never leave a task as pairs: each anchor's members are compared there, and a spanning forest
of the links goes on to the distributed components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, ids_and_bytes, saved, text_slices
from courtlake.llm.components import components

SEED = 42
#: Covering radius of the code, and how far linked fingerprints may be apart in one block.
RADIUS, BLOCK_BITS = 1, 2


@dataclass(frozen=True)
class Sketch:
    """Which fingerprint is compared, and which blocks of 32 or 64 bits lead to the anchors.

    ``probe_words`` is None when the compared fingerprint itself is the only block. Otherwise
    blocks come from a second fingerprint over the distinct runs of that many words: a changed
    word disturbs it less, so that similar texts share a block within ``BLOCK_BITS``.
    """

    words: int = 3
    lanes: int = 1
    max_bits: int = 2
    probe_words: int | None = None
    probe_lanes: int = 0

    @property
    def code_order(self) -> int:
        return 6 if self.probe_words is None else 5


#: Linked: at most 2 of 64 bits differ, three-word shingles.
TWO_BITS = Sketch()


def _byte_bits() -> np.ndarray:
    return ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


_BYTE_BITS = _byte_bits()
_BYTE_PLACE = (np.arange(8) * 256).astype(np.int64)


def _majority(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit word: the bits set in over half of the hashes."""
    if not len(hashes):
        return np.zeros(1, np.uint64)
    places = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_PLACE
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return np.packbits(counts.ravel() * 2 > len(hashes), bitorder="little").view(np.uint64)


def _lanes(hashes: np.ndarray, lanes: int) -> np.ndarray:
    """Further independent 64-bit words come from mixing the same hashes."""
    words = [_majority(hashes)]
    for lane in range(1, lanes):
        mixed = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15 + 2 * lane)
        words.append(_majority(mixed ^ (mixed >> np.uint64(29))))
    return np.concatenate(words)


def shingle_hashes(text: bytes, words: int, distinct: bool = False) -> np.ndarray:
    """XXH64 of every run of so many words; fewer words give one run, none gives no hash."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if words == 1:
        runs = found
    else:
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
        runs = [joined[a:b] for a, b in zip(starts, ends[words - 1:].tolist())] or [joined]
    digest = xxhash.xxh64_intdigest
    runs = set(runs) if distinct else runs
    return np.fromiter((digest(r, SEED) for r in runs), np.uint64, len(runs))


def sketch_of(text: bytes, kind: Sketch) -> bytes:
    """The compared words, then the words that the blocks are cut from."""
    compared = _lanes(shingle_hashes(text, kind.words, kind.probe_words is not None), kind.lanes)
    if kind.probe_words is None:
        return compared.tobytes()
    probes = _lanes(shingle_hashes(text, kind.probe_words, True), kind.probe_lanes)
    return np.concatenate([compared, probes]).tobytes()


def sketches(docs: DataFrame, kind: Sketch = TWO_BITS) -> DataFrame:
    """``doc_id, sketch`` of every row. A null or blank text has the sketch of no shingles: zero."""
    schema = pa.schema([("doc_id", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            yield arrow_batch(schema, doc_id=part.column("doc_id"),
                              sketch=[sketch_of(t, kind) for t in texts])

    return ids_and_bytes(docs).mapInArrow(run, "doc_id long, sketch binary")


def code_masks(order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome the differences to all anchors within ``RADIUS`` + 1 bits; which count.

    Bit i-1 of a word (i = 1 .. 2^order - 1) has check value i; the last bit is free. The anchors
    are the words whose set bits have check values that cancel out.
    """
    size = 1 << order
    free = 1 << (size - 1)
    masks = np.zeros((size, size // 2 + 1), np.uint64)
    valid = np.zeros(masks.shape, bool)
    for syndrome in range(size):
        near = [1 << (syndrome - 1)] if syndrome else [0]
        pairs = [(1 << (i - 1)) | (1 << ((i ^ syndrome) - 1))
                 for i in range(1, size) if 0 < (i ^ syndrome) and i < (i ^ syndrome)]
        row = near + (pairs if syndrome else []) + [near[0] | free]
        masks[syndrome, :len(row)] = row
        valid[syndrome, :len(row)] = True
    return masks, valid


def anchors_of(values: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and anchors: every anchor within 2 bits of each value."""
    masks, valid = code_masks(order)
    syndrome = np.zeros(len(values), np.int64)
    for bit in range(order):
        check = sum(1 << (i - 1) for i in range(1, 1 << order) if i >> bit & 1)
        syndrome |= (np.bitwise_count(values & np.uint64(check)).astype(np.int64) & 1) << bit
    found = values[:, None] ^ masks[syndrome]
    rows, places = np.nonzero(valid[syndrome])
    return rows, found[rows, places]


def _anchor_rows(prints: DataFrame, kind: Sketch) -> DataFrame:
    """``anchor, block, rep, sketch`` (the compared part): one row for each anchor of each print."""
    schema = pa.schema([("anchor", pa.int64()), ("block", pa.int32()), ("rep", pa.int64()),
                        ("sketch", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_numpy(zero_copy_only=False)
            words = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint64)
            words = words.reshape(batch.num_rows, -1)
            compared = words[:, :kind.lanes]
            if kind.probe_words is None:
                blocks = [words[:, 0]]
            else:
                probes = np.ascontiguousarray(words[:, kind.lanes:]).view(np.uint32)
                blocks = [probes[:, i].astype(np.uint64) for i in range(probes.shape[1])]
            for number, values in enumerate(blocks):
                rows, anchors = anchors_of(values, kind.code_order)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * (8 * kind.lanes)
                data = np.ascontiguousarray(compared[rows]).tobytes()
                yield arrow_batch(
                    schema, anchor=pa.array(anchors.view(np.int64)),
                    block=pa.array(np.full(len(rows), number, np.int32)),
                    rep=pa.array(reps[rows]),
                    sketch=pa.Array.from_buffers(
                        pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)]))

    return prints.select("rep", "sketch").mapInArrow(
        run, "anchor long, block int, rep long, sketch binary")


def _forest(key: np.ndarray, reps: np.ndarray, words: np.ndarray, max_bits: int):
    """A spanning forest of the links among rows of equal key (rows sorted by key)."""
    n = len(reps)
    label = np.arange(n)
    rows = np.arange(n - 1)
    pairs: list[tuple[int, int]] = []
    step = 1
    while len(rows):
        rows = rows[rows + step < n]
        rows = rows[key[rows] == key[rows + step]]
        open_ = rows[label[rows] != label[rows + step]]
        bits = np.bitwise_count(words[open_] ^ words[open_ + step]).sum(axis=1)
        for i in open_[bits <= max_bits].tolist():
            a, b = label[i], label[i + step]
            if a != b:
                lo, hi = np.searchsorted(key, key[i]), np.searchsorted(key, key[i], "right")
                part = label[lo:hi]
                part[part == max(a, b)] = min(a, b)
                pairs.append((reps[i], reps[i + step]))
        step += 1
    return pairs


def _links(anchors: DataFrame, kind: Sketch) -> DataFrame:
    """``a, b``: links found at the anchors, a spanning forest for each anchor."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            keys = _group_numbers(rest)
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last group goes on
            if cut:
                yield _found(rest.slice(0, cut), keys[:cut])
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield _found(rest, _group_numbers(rest))

    def _group_numbers(batch: pa.RecordBatch) -> np.ndarray:
        anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        new = (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1])
        return np.concatenate([[0], np.cumsum(new)]) if len(anchor) else np.zeros(0, np.int64)

    def _found(batch: pa.RecordBatch, keys: np.ndarray) -> pa.RecordBatch:
        shared = np.bincount(keys)[keys] > 1
        reps = batch.column("rep").to_numpy(zero_copy_only=False)[shared]
        packed = batch.column("sketch").filter(pa.array(shared)).to_pylist()
        words = np.frombuffer(b"".join(packed), np.uint64).reshape(len(packed), kind.lanes)
        pairs = _forest(keys[shared], reps, words, kind.max_bits)
        return arrow_batch(schema, a=[int(p[0]) for p in pairs], b=[int(p[1]) for p in pairs])

    return anchors.repartition("anchor", "block").sortWithinPartitions("anchor", "block") \
        .mapInArrow(run, "a long, b long")


def near_groups(spark: SparkSession, docs: DataFrame, kind: Sketch = TWO_BITS) -> DataFrame:
    """``doc_id, sketch, component_id`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links, the row's own included. Null and
    blank texts share the zero sketch and are linked like any other. Repeated rows stay. A null
    doc_id never names a group: it gets the smallest other id of its sketch, or null. Extra
    columns are left behind; an empty table gives an empty one.
    """
    return sketch_groups(spark, saved(spark, sketches(docs, kind), "simhash-sketches"), kind)


def sketch_groups(spark: SparkSession, own: DataFrame, kind: Sketch = TWO_BITS) -> DataFrame:
    """As :func:`near_groups`, for written rows of ``doc_id, sketch``."""
    prints = saved(spark, own.groupBy("sketch").agg(F.min("doc_id").alias("rep")),
                   "simhash-prints")
    links = _links(_anchor_rows(prints.where("rep is not null"), kind), kind)
    roots = components(spark, links, "simhash-links")
    named = saved(
        spark,
        prints.join(roots, prints.rep == roots.node, "left").select(
            "sketch", F.coalesce("root", "rep").alias("component_id")),
        "simhash-named",
    )
    return own.join(named, "sketch").select("doc_id", "sketch", "component_id")


def one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near copies the one with the smallest doc_id.

    Near copies have SimHash fingerprints at most 2 bits apart, or similarity 0.8 or more over
    five-word runs, compared exactly (``similar.py``).
    Rows that repeat this doc_id stay with it; rows without a doc_id can't be told apart and all
    stay. All columns are kept.
    """
    from courtlake.llm.similar import similar_groups  # it takes its runs of words from here

    gone = similar_groups(spark, docs, fingerprints=True).where("doc_id <> component_id").select(
        F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs.doc_id == F.col("_gone"), "left_anti")


def fingerprint_hex(sketch: F.Column) -> F.Column:
    """The first 64-bit word as 16 lowercase hex digits (stored with its low byte first)."""
    return F.lower(F.concat(*[F.hex(F.substring(sketch, i, 1)) for i in range(8, 0, -1)]))
