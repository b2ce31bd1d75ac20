"""Line dedup that can be undone: cuckoo filters in front of exact reference counts.

A state is a folder. Each increment, an insertion or a deletion of documents, adds to it:

- ``postings``: key of a line, document, +1 or -1;
- ``counts``: for every key it touched the number of documents that hold it now, and the largest;
  every ``COMPACTED``-th holds all keys, so that none before it is read again;
- ``filters``: a cuckoo filter for each shard of keys, with the keys whose count isn't zero.

An increment first merges its own keys (on the map side, so a line of every document stays small),
then asks the filter of each shard. A key that the filter doesn't know is new: its count is the
increment's. Only keys that may be known are looked up in the exact counts, which also correct the
filter's false positives. Keys are 128-bit digests of the lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtlake.llm.common import saved, text_slices, unused
from courtlake.llm.cuckoo import CuckooFilter
from courtlake.session import shared_dir

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of one shard that an increment is planned for; more make its filter grow by a table.
SHARD_KEYS = 1 << 18
#: Increments after which the counts of all keys are written as one table.
COMPACTED = 8
#: Parts, by a hash of the row, in which ``insert_parts`` inserts documents.
PARTS = 3


@dataclass(frozen=True)
class LineState:
    """Where the tables are, how many increments they hold, and how keys are dealt to shards."""

    path: str
    shards: int
    increments: int = 0
    #: First increment whose counts are still read.
    base: int = 0

    def folder(self, table: str, increment: int | None = None) -> str:
        return f"{self.path}/{table}/{self.increments if increment is None else increment}"


def new_state(path: str, expected_lines: int) -> LineState:
    shards = 1
    while shards * SHARD_KEYS < expected_lines:
        shards *= 2
    return LineState(path, shards)


def line_key(line: bytes) -> bytes | None:
    """Digest of the stripped line in lower case (A-Z); None below ``MIN_CHARS`` code points."""
    line = line.strip(WHITE).lower()
    if len(line) < MIN_CHARS or len(line) < 4 * MIN_CHARS and len(line.decode()) < MIN_CHARS:
        return None
    return hashlib.blake2b(line, digest_size=16).digest()


def line_keys(docs: DataFrame) -> DataFrame:
    """``doc_id, row, key``: the different keys of each document; ``row`` tells rows of one id apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = [{k for k in map(line_key, t.split(b"\n")) if k} for t in texts]
            nth = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id").take(nth), "row": part.column("row").take(nth),
                "key": pa.array([k for f in found for k in f], pa.binary())})

    return _rows(docs).mapInArrow(run, "doc_id long, row long, key binary")


def _rows(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("row"), "text")


def _shard(state: LineState) -> F.Column:
    return F.pmod(F.xxhash64("key"), F.lit(state.shards)).cast("int")


def _numbers(keys: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2)


def _filters(spark: SparkSession, state: LineState) -> DataFrame:
    if not state.increments:
        return spark.createDataFrame([], "shard int, data binary")
    return spark.read.parquet(state.folder("filters", state.increments - 1))


def _all_counts(spark: SparkSession, state: LineState) -> DataFrame:
    """``increment, key, n_docs, last_doc`` of every increment that still counts."""
    if not state.increments:
        return spark.createDataFrame([], "increment int, key binary, n_docs long, last_doc long")
    tables = [spark.read.parquet(state.folder("counts", i)).withColumn("increment", F.lit(i))
              for i in range(state.base, state.increments)]
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.union(t)
    return rows


def _latest(rows: DataFrame) -> DataFrame:
    latest = F.max(F.struct("increment", "n_docs", "last_doc")).alias("latest")
    return rows.groupBy("key").agg(latest).select("key", "latest.n_docs", "latest.last_doc")


def _counts(spark: SparkSession, state: LineState, keys: DataFrame) -> DataFrame:
    """Exact ``key, n_docs, last_doc`` of the given distinct keys: what their latest increment wrote."""
    return _latest(_all_counts(spark, state).join(keys.select("key"), "key", "left_semi"))


def _probed(spark: SparkSession, state: LineState, keys: DataFrame) -> DataFrame:
    """``key, n, last, maybe_known``: one task a shard asks its filter for the increment's keys."""
    schema = "key binary, n long, last long, maybe_known boolean"

    def probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        known = CuckooFilter(SHARD_KEYS // 4, b"".join(filters["data"])).contains(_numbers(keys["key"])) \
            if len(keys) else np.zeros(0, bool)
        return keys[["key", "n", "last"]].assign(maybe_known=known)

    grouped = keys.withColumn("shard", _shard(state)).groupBy("shard")
    return grouped.cogroup(_filters(spark, state).groupBy("shard")).applyInPandas(probe, schema)


def _changed_filters(spark: SparkSession, state: LineState, changes: DataFrame) -> DataFrame:
    """Filters after ``changes(key, up)``: true puts a key in, false takes it out."""

    def apply(shard: tuple, changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        kept = CuckooFilter(SHARD_KEYS // 4, b"".join(filters["data"]))
        if len(changes):
            kept.delete(_numbers(changes["key"][~changes["up"]]))
            kept.insert(_numbers(changes["key"][changes["up"]]))
        return pd.DataFrame({"shard": [shard[0]], "data": [kept.to_bytes()]})

    grouped = changes.withColumn("shard", _shard(state)).groupBy("shard")
    return grouped.cogroup(_filters(spark, state).groupBy("shard")).applyInPandas(
        apply, "shard int, data binary")


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _increment(spark: SparkSession, state: LineState, docs: DataFrame, change: int) -> LineState:
    pairs = _write(line_keys(docs).withColumn("change", F.lit(change)), state.folder("postings"))
    keys = pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    probed = _write(_probed(spark, state, keys), state.folder("probed"))
    maybe = probed.where("maybe_known")
    old = _counts(spark, state, maybe)
    seen = maybe.join(old, "key", "left").select(
        "key", "n", "last", F.coalesce("n_docs", F.lit(0)).alias("before"), "last_doc")
    new = probed.where("not maybe_known").select(
        "key", "n", "last", F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("last_doc"))
    rows = seen.union(new).withColumn("n_docs", F.col("before") + change * F.col("n"))
    if change > 0:
        rows = rows.withColumn("last_doc", F.greatest("last", "last_doc"))
    else:
        # The postings are asked only for keys that lose their largest document and are still held.
        rows = saved(spark, rows.select("key", "before", "n_docs", "last", "last_doc"), "lines-deleted")
        asked = rows.where("n_docs > 0 and last <=> last_doc")
        found = _largest(spark, state, asked).withColumnRenamed("last_doc", "found")
        rows = rows.join(found, "key", "left").withColumn(
            "last_doc", F.when(F.expr("n_docs > 0 and last <=> last_doc"), F.col("found"))
            .when(F.col("n_docs") > 0, F.col("last_doc")))
    rows = saved(spark, rows.select("key", "before", "n_docs", "last_doc"), "lines-changed")
    counts, base = rows.select("key", "n_docs", "last_doc"), state.base
    if (state.increments + 1) % COMPACTED == 0:
        former = _all_counts(spark, state).select("increment", "key", "n_docs", "last_doc")
        now = counts.select(F.lit(state.increments).alias("increment"), "key", "n_docs", "last_doc")
        counts, base = _latest(former.union(now)).where("n_docs > 0"), state.increments
    counts.write.parquet(state.folder("counts"))
    changes = rows.where("(before = 0) <> (n_docs = 0)").select("key", (F.col("n_docs") > 0).alias("up"))
    _changed_filters(spark, state, changes).write.parquet(state.folder("filters"))
    return replace(state, increments=state.increments + 1, base=base)


def _largest(spark: SparkSession, state: LineState, keys: DataFrame) -> DataFrame:
    """``key, last_doc`` of these distinct keys from all postings, the present increment's included."""
    rows = spark.read.parquet(*[state.folder("postings", i) for i in range(state.increments + 1)])
    held = rows.join(keys.select("key"), "key", "left_semi").groupBy("key", "doc_id").agg(
        F.sum("change").alias("held")).where("held > 0")
    return held.groupBy("key").agg(F.max("doc_id").alias("last_doc"))


def insert(spark: SparkSession, state: LineState, docs: DataFrame) -> LineState:
    return _increment(spark, state, docs, 1)


def delete(spark: SparkSession, state: LineState, docs: DataFrame) -> LineState:
    """Undo the insertion of ``docs``: the same rows, with their texts as they were inserted."""
    return _increment(spark, state, docs, -1)


def of_part(docs: DataFrame, part: int, parts: int = PARTS) -> DataFrame:
    """One of ``parts`` shares of the rows, by a hash of doc_id and text."""
    return docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) == part)


def insert_parts(spark: SparkSession, state: LineState, docs: DataFrame, parts: int = PARTS) -> LineState:
    """Insert all rows in ``parts`` increments; each but the first asks the filters of those before."""
    for part in range(parts):
        state = insert(spark, state, of_part(docs, part, parts))
    return state


def postings(spark: SparkSession, state: LineState, increments: Iterable[int]) -> DataFrame:
    """``doc_id, row, key`` as these increments, insertions, have written them."""
    return spark.read.parquet(*[state.folder("postings", i) for i in increments]).drop("change")


def repeated(spark: SparkSession, state: LineState, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key, last_doc`` of all keys that at least ``min_docs`` documents hold now."""
    rows = _all_counts(spark, state)
    # A key that reached the number has a row that says so; of the others none goes through a shuffle.
    often = rows.where(F.col("n_docs") >= min_docs).select("key").distinct()
    return _latest(rows.join(often, "key", "left_semi")).where(F.col("n_docs") >= min_docs).select("key", "last_doc")


def drop_repeated(spark: SparkSession, state: LineState, docs: DataFrame, pairs: DataFrame,
                  min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the repeated lines out of ``text``, and ``n_lines, n_dropped`` added.

    ``pairs`` are the documents' ``line_keys``, as an increment has written them. All other columns
    pass. A text that loses no line is the same as before, a null one included.
    """
    often = saved(spark, repeated(spark, state, min_docs), "lines-repeated")
    gone = saved(
        spark,
        pairs.join(often, "key").where("not (doc_id <=> last_doc)").select("doc_id", "row", "key"),
        "lines-gone",
    ).groupBy("doc_id", "row").agg(F.collect_set("key").alias("_gone_keys"))
    doc_id, row, gone_doc, gone_row, gone_keys = unused(docs, "_doc_id", "_row", "_gone_doc", "_gone_row", "_gone_keys")
    marked = docs.withColumn(doc_id, F.col("doc_id").cast("long")).withColumn(row, F.xxhash64(doc_id, "text"))
    joined = marked.join(
        gone.toDF(gone_doc, gone_row, gone_keys),
        F.col(doc_id).eqNullSafe(F.col(gone_doc)) & (F.col(row) == F.col(gone_row)),
        "left").select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")], gone_keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            gone = part.column(gone_keys).to_pylist()
            total, dropped, kept = [], [], []
            for was, text, keys in zip(part.column("text"), texts, gone):
                lines = text.split(b"\n")
                total.append(len(lines))
                if keys:
                    keys = set(keys)
                    stay = [x for x in lines if line_key(x) not in keys]
                    dropped.append(len(lines) - len(stay))
                    kept.append(b"\n".join(stay))
                else:
                    dropped.append(0)
                    kept.append(text if was.is_valid else None)
            columns = {n: part.column(n) for n in part.schema.names if n != gone_keys}
            columns["text"] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(
                columns | {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())})

    fields = [f for f in joined.schema if f.name != gone_keys]
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return joined.mapInArrow(run, schema)


def state_for(spark: SparkSession, docs: DataFrame) -> LineState:
    """A new state with shards for the lines of ``docs``, in a folder of its own."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return new_state(shared_dir(spark, "lines"), size // 100)


def dedup_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """All ``docs``, inserted into a new state in ``PARTS`` increments, then without their repeated lines.

    A line repeated in ``min_docs`` rows or more stays in the rows of the largest doc_id that holds
    it. Null and empty texts are one empty line; every row counts as a document, also one that
    repeats a doc_id; rows without doc_id lose repeated lines to any row that has one. An empty
    table gives an empty one.
    """
    state = insert_parts(spark, state_for(spark, docs), docs)
    return drop_repeated(spark, state, docs, postings(spark, state, range(PARTS)), min_docs)
