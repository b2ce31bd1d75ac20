"""From raw documents to packed sequences: quality, lines, near copies, test items, packing.

``run(spark, sf_dir)`` applies ``STAGES`` to the table ``documents``. Each stage takes the session,
the documents its predecessor kept, and the folder of the tables; all but the last give back the
columns of ``documents``. Between stages the documents are written to the shared folder and read
again, so that no stage is computed twice and lost executors cost no more than their own tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm import decontaminate, quality, simhash
from courtlake.llm.common import documents, saved
from courtlake.llm.line_dedup import dedup_lines
from courtlake.llm.packing import pack

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only rows that the compression classifier, trained on ``labels``, takes for good."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many documents share; ``n_chars`` follows where a text changed."""
    kept = dedup_lines(spark, docs)
    changed = kept
    if "n_chars" in docs.columns:
        chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
        changed = kept.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of exact and near copies (five words, similarity 0.8)."""
    return simhash.one_of_each(spark, docs)


def no_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only rows that hold no item of ``benchmark``."""
    return decontaminate.without_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their ids and their places in sequences of 1024."""
    return pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("line dedup", fresh_lines),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", no_test_items),
    ("best-fit packing", packed),
]

#: Compression, fingerprints and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-').lower()}")
    return docs
