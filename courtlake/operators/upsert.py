"""Keyed upsert as joins of two DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtlake.operators.dedupe import assert_unique, keep_first, refuse_null_keys
from courtlake.operators.refs import Reference, all_references, fk_flags


def upsert(target: DataFrame, source: DataFrame, keys: list[str],
           unless_later: str | None = None, unique: bool = False) -> DataFrame:
    """The target after inserting new keys and updating known ones.

    A known key takes every non-key column the source supplies, nulls included;
    columns the source does not supply keep their value (null on insert). A
    source that is all key changes nothing on a known key. A repeated or null
    source key fails the query. Applying the same source twice equals once.
    ``unless_later`` names a column of both: a known row with a larger value stays.
    ``unique``: the source has one row for each key already, so only null keys are looked for.
    """
    supplied = [c for c in source.columns if c not in keys]
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")
    if not supplied:
        return insert_if_absent(target, source, keys)
    types = dict(target.dtypes)
    incoming = (refuse_null_keys if unique else assert_unique)(source, keys).select(
        *[F.col(k).cast(types[k]).alias(k) for k in keys],
        *[F.col(c).cast(types[c]).alias(f"_new_{c}") for c in supplied],
        F.lit(True).alias("_hit"),
    )
    joined = target.join(incoming, keys, "full_outer")
    hit = F.col("_hit")
    if unless_later:
        hit = hit & ~F.coalesce(F.col(unless_later) > F.col(f"_new_{unless_later}"), F.lit(False))
    return joined.select(*[
        F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in supplied else F.col(c)
        for c in target.columns
    ])


def new_rows(target: DataFrame, source: DataFrame, keys: list[str],
             order: list[str] | None = None, unique: bool = False) -> DataFrame:
    """Source rows whose key the target lacks, one per key (the first in ``order``).

    ``unique``: the source has one row for each key already.
    """
    if unique:
        first = source
    else:
        first = keep_first(source, keys, order) if order else source.dropDuplicates(keys)
    # A key without a null-safe match is new; null keys are the caller's to drop.
    return first.join(target.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str],
                     order: list[str] | None = None) -> DataFrame:
    """The target plus source rows with new keys; known rows stay untouched."""
    fresh = new_rows(target, source, keys, order)
    kept = [c for c in fresh.columns if c in target.columns]
    return target.unionByName(fresh.select(*kept), allowMissingColumns=True)


def upsert_counts(source: DataFrame, references: list[Reference], table: str) -> DataFrame:
    """One row (table, staged, loaded, dropped) for a load of ``source``."""
    flagged = fk_flags(source, references).select(all_references(references).alias("_ok"))
    return flagged.agg(
        F.count(F.lit(1)).alias("staged"), F.count_if("_ok").alias("loaded")
    ).select(
        F.lit(table).alias("table"), "staged", "loaded",
        (F.col("staged") - F.col("loaded")).alias("dropped"),
    )
