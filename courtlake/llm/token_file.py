"""Token ids in ORC: written in order of doc_id, found again by stripe and by Bloom filter.

Integer columns of ORC are run-length encoded; every stripe carries row indexes and a Bloom filter
on doc_id, so a reader takes stripes in parallel and skips those without a wanted document. A
row also holds how many ids stand before it in its own file. The files' totals, one row a file,
turn this into the place in the whole output.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtlake.llm.common import arrow_batch, saved, text_slices
from courtlake.llm.tokens import encoder, id_bytes, id_lists

STRIPE_BYTES = 32 << 20
INDEX_ROWS = 1000


def write_tokens(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool, end_id: int) -> None:
    """Write ``doc_id, place, n_tokens, ids`` of ``docs(doc_id, text)`` in ascending doc_id order.

    Null and empty texts hold the end id only. Rows without doc_id come first; rows that repeat a
    doc_id stand beside each other, ordered by a hash of their text.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.list_(pa.int32()))])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, place = encoder(tokenizer, keeps_space).ids, 0
        for part, texts in text_slices(batches, encoding=True):
            found = [ids + end for ids in encode(texts)]
            sizes = np.array([len(ids) // 4 for ids in found], np.int64)
            ends = place + np.cumsum(sizes)
            yield arrow_batch(schema, doc_id=part.column("doc_id"), place=pa.array(ends - sizes),
                              n_tokens=pa.array(sizes), ids=id_lists(found))
            place = int(ends[-1])

    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"),
        F.xxhash64(text).alias("tie"),
    ).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = ordered.mapInArrow(run, "doc_id long, place long, n_tokens long, ids array<int>")
    rows.write.options(**{
        "orc.stripe.size": STRIPE_BYTES, "orc.row.index.stride": INDEX_ROWS,
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": 0.01,
    }).orc(path)


def _offsets(spark: SparkSession, path: str) -> DataFrame:
    """Ids in all files before each file; reads two narrow columns, gives one row a file."""
    files = spark.read.orc(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy(F.asc_nulls_first("low"), "high", "file").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return saved(spark, files.select("file", (F.sum("n").over(before) - F.col("n")).alias("before")),
                 "token-offsets")


def token_digests(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files: place in the whole output, checksum.

    ``doc_ids``: only these documents; stripes without them are skipped by index and Bloom filter.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("file", pa.string()), ("place", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            yield arrow_batch(
                schema, doc_id=batch.column("doc_id"), file=batch.column("file"),
                place=batch.column("place"), n_tokens=ids.value_lengths().cast(pa.int64()),
                ids_crc32=[zlib.crc32(b) for b in id_bytes(ids)])

    rows = spark.read.orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(doc_ids))
    rows = rows.select("doc_id", F.col("_metadata.file_name").alias("file"), "place", "ids")
    found = rows.mapInArrow(
        run, "doc_id long, file string, place long, n_tokens long, ids_crc32 long")
    return found.join(_offsets(spark, path), "file").select(
        "doc_id", (F.col("before") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
