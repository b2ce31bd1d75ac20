"""What the operators of this subpackage share: inputs, written tables, Arrow pieces."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.tokens import forget
from courtlake.session import shared_dir

#: Rows of one Arrow batch that a task hands back to Spark.
OUT_ROWS = 2048
#: Bytes of text that a task works on at once; a single longer text is still taken whole.
TEXT_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: its lineage ends there."""
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until no column of ``df`` has it, in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def ids_and_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text as UTF-8 bytes, null as empty; any other column is left behind."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )


def text_slices(batches: Iterable[pa.RecordBatch],
                encoding: bool = False) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in slices of about ``TEXT_BYTES``, each with its texts as bytes, null as empty.

    A task that isn't ``encoding`` frees what a tokenizer left in its worker process.
    """
    if not encoding:
        forget()
    for batch in batches:
        texts = batch.column("text")
        start, size = 0, 0
        for i in range(batch.num_rows):
            size += len(texts[i].as_buffer()) if texts[i].is_valid else 0
            if size >= TEXT_BYTES or i - start + 1 >= OUT_ROWS or i + 1 == batch.num_rows:
                part = batch.slice(start, i + 1 - start)
                found = part.column("text").cast(pa.binary()).to_pylist()
                yield part, [t or b"" for t in found]
                start, size = i + 1, 0


def arrow_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, schema.field(n).type)
         for n, c in columns.items()],
        schema=schema,
    )
