"""Quality by compression: a text packs better with a dictionary of texts like it.

Zstandard dictionaries are built from good and from bad labelled text. A text is compressed in
chunks with either one; the difference of the two sizes over their sum, and the size for each byte,
go through a logistic curve fitted on other labelled rows. Only bounded samples of labelled rows
leave the executors: ``ROWS`` rows of each label for the dictionaries, ``CHUNKS`` chunks of each
row, and two numbers of each of ``ROWS`` further rows of each label for the curve. All rows are
scored, over their whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, ids_and_bytes, text_slices

#: Labelled rows of each label for the dictionaries, and again for the curve.
ROWS = 1500
#: Bytes of a chunk, and how many chunks of one text go into a dictionary, spread over the text.
CHUNK, CHUNKS = 512, 8
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: A text with this score or more is predicted to be good.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """``weights``: constant, difference, size. No dictionaries: every text scores ``share``."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    share: float


def held_out(doc_id: F.Column) -> F.Column:
    """The fifth of the rows that no label is learned from; rows without doc_id belong to it."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def _sample(labels: DataFrame, label: int, order: str) -> DataFrame:
    """``ROWS`` times two rows of one label, in a fixed arbitrary order; ``part`` tells them apart."""
    rows = labels.where((F.col(order) == label) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("labelled"), F.lit(label).alias("label"))
    return rows.orderBy(F.xxhash64("labelled"), "labelled").limit(2 * ROWS).withColumn(
        "part", F.pmod(F.xxhash64("labelled", F.lit(1)), F.lit(2)))


def _labelled(docs: DataFrame, sample: list, part: int) -> DataFrame:
    """``doc_id, text`` of the sampled rows of one part; the doc_id is replaced by the label."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame(
        sorted({(r.labelled, r.label) for r in sample if r.part == part}) or [(None, None)],
        "labelled long, label long")
    # At most 4 * ROWS rows of two numbers.
    rows = docs.select("doc_id", "text").join(
        F.broadcast(wanted), F.col("doc_id").cast("long") == F.col("labelled"))
    return rows.select(F.col("label").alias("doc_id"), "text")


def _chunks(text: bytes) -> list[bytes]:
    return [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)] or [b""]


def _dictionary(chunks: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, chunks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(chunks)[-DICTIONARY_BYTES:]


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False,
                                    write_content_size=False, write_dict_id=False)


def sizes(text: bytes, good: bytes, bad: bytes) -> tuple[float, float]:
    """Difference of the compressed sizes over their sum, and the size for each byte."""
    chunks = _chunks(text)
    a, b = (sum(len(c.compress(x)) for x in chunks) for c in (_compressor(good), _compressor(bad)))
    return (b - a) / (a + b), a / max(len(text), 1)


def _curve(features: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method, lightly regularised."""
    mean, spread = features.mean(0), features.std(0) + 1e-9
    x = np.c_[np.ones(len(features)), (features - mean) / spread]
    w = np.zeros(x.shape[1])
    hold = np.diag([0.0] + [1e-3 * weight.sum()] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + hold + 1e-9 * np.eye(len(w))
        w += np.linalg.solve(curvature, x.T @ (weight * (labels - p)) - hold @ w)
    slopes = w[1:] / spread
    return (float(w[0] - slopes @ mean), *map(float, slopes))


def train(docs: DataFrame, labels: DataFrame, column: str = "quality") -> Model:
    """Learn from the rows of ``labels`` that aren't held out; null labels count for nothing."""
    counts = {r[0]: r[1] for r in labels.where(F.col(column).isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy(column).count().collect()}
    share = counts.get(1, 0) / max(sum(counts.values()), 1) if counts else 0.5
    sample = [r for label in (0, 1) for r in _sample(labels, label, column).collect()]

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            rows = [(label, c) for label, t in zip(part.column("doc_id").to_pylist(), texts)
                    for chunks in [_chunks(t)] for c in chunks[::-(-len(chunks) // CHUNKS)]]
            yield pa.RecordBatch.from_pydict(
                {"label": pa.array([r[0] for r in rows], pa.int64()),
                 "chunk": pa.array([r[1] for r in rows], pa.binary())})

    found = ids_and_bytes(_labelled(docs, sample, 0)).mapInArrow(cut, "label long, chunk binary")
    chunks: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(found.collect()):
        chunks[row.label].append(bytes(row.chunk))
    if not (any(chunks[0]) and any(chunks[1])):
        return Model(b"", b"", (), share)
    good, bad = _dictionary(chunks[1]), _dictionary(chunks[0])
    rows = _sized(ids_and_bytes(_labelled(docs, sample, 1)), good, bad).collect()
    y = np.array([r.doc_id for r in rows], float)
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", (), share)
    # Weights bring back the shares that the labels have before the sampling.
    weight = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum()) * len(y)
    x = np.array([(r.difference, r.size) for r in rows])
    return Model(good, bad, _curve(x, y, weight), share)


def _sized(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("difference", pa.float64()), ("size", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = [sizes(t, good, bad) for t in texts]
            yield arrow_batch(schema, doc_id=part.column("doc_id"),
                              difference=[f[0] for f in found], size=[f[1] for f in found])

    return rows.mapInArrow(run, "doc_id long, difference double, size double")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: more likely good) of every row, from its text alone.

    Null and empty texts are scored as an empty chunk. Repeated rows stay; extra columns are left
    behind; an empty table gives an empty one. A model that saw one label only gives its share.
    """
    if not model.weights:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(model.share).alias("score"))
    constant, by_difference, by_size = model.weights
    z = constant + by_difference * F.col("difference") + by_size * F.col("size")
    return _sized(ids_and_bytes(docs), model.good, model.bad).select(
        "doc_id", (1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).alias("score"))


def keep_good(docs: DataFrame, model: Model, least: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with this score or more, all columns kept; each row is judged by itself."""
    if not model.weights:
        return docs.where(F.lit(model.share >= least))
    constant, by_difference, by_size = model.weights

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = np.array([sizes(t, model.good, model.bad) for t in texts])
            z = constant + found @ (by_difference, by_size)
            yield part.filter(pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))) >= least))

    return docs.mapInArrow(run, docs.schema)
