"""Keep-first, keep-last and duplicate counts.

``row_number() = 1`` over a key is planned with a group limit on both sides of
the shuffle: each task forwards at most one row per key, so a key that holds
much of the table still arrives as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order (null keys are equal)."""
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", first).where(F.col("_rn") == 1).drop("_rn")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in the given order."""
    return keep_first(df, keys, [F.col(c).desc() for c in order])


def duplicate_count(df: DataFrame, keys: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows beyond the first per key, in all or per ``by`` group (null keys are equal)."""
    per_key = df.groupBy(*(by or []), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return (
        per_key.agg(F.count(F.lit(1)).alias("_n")).groupBy(*(by or []))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))
    )


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of one column."""
    return df.select(column).na.drop().distinct()


def drop_null_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)


def _null_key(keys: list[str]) -> Column:
    """Fails the query with the key in words."""
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    return F.raise_error(F.concat(F.lit(f"null in key ({', '.join(keys)}) = ("), shown, F.lit(")")))


def refuse_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; a null key fails the query."""
    types = dict(df.dtypes)
    return df.withColumns({k: F.coalesce(F.col(k), _null_key(keys).cast(types[k])) for k in keys})


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows; a repeated or null key fails the query.

    One row is kept per key while counting, so even a key repeated very often
    is never gathered. Behind :func:`keep_first` the shuffle is already there.
    """
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.first(F.struct(F.lit(0).alias("_"), *rest)).alias("_row"),
    )
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    label = f"({', '.join(keys)}) = ("
    no_null = F.lit(True)
    for key in keys:
        no_null = no_null & F.col(key).isNotNull()
    row = (
        F.when((F.col("_n") == 1) & no_null, F.col("_row"))
        .when(~no_null, _null_key(keys))
        .otherwise(F.raise_error(F.concat(F.lit(f"repeated key {label}"), shown, F.lit(")"))))
    )
    checked = grouped.select(*keys, row.alias("_row"))
    # Naming a struct field forces the check even when no other column is read.
    return checked.where(F.col("_row._") == 0).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
