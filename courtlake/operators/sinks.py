"""Writes of silver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.session import compiled
from courtlake.sources.files import file_system, path_exists


def write_partitioned(df: DataFrame, path: str, partitions: tuple[str, ...] = ("season", "game_date"),
                      ) -> None:
    """Replace exactly the partitions ``df`` has rows for.

    Rebalancing gathers the rows of a partition for few files, and splits a
    partition that is too large for one task.
    """
    with compiled(df.sparkSession):
        (
            df.hint("rebalance", *partitions)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions).parquet(path)
        )


def write_dim(df: DataFrame, path: str) -> None:
    """Replace an unpartitioned table."""
    df.write.mode("overwrite").parquet(path)


def stage_dim(df: DataFrame, path: str) -> str:
    """Write a table beside ``path``; nothing reads it before :func:`switch_dim`."""
    folder, name = path.rsplit("/", 1)
    staged = f"{folder}/_staging/{name}-{uuid.uuid4().hex}"
    with compiled(df.sparkSession):
        df.write.parquet(staged)
    return staged


def switch_dim(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged table in the place of the old one, which goes last."""
    fs, source = file_system(spark, staged)
    _, target = file_system(spark, path)
    _, aside = file_system(spark, f"{staged}-old")
    had = path_exists(spark, path)
    if had and not fs.rename(target, aside):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(source, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"could not move {staged} to {path}")
    if had:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(path)


def ordered_layout(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Rows ranged and sorted by an access path, for tight min/max per file.

    Ranging on the whole order, not on its first column, lets one large game
    spread over several files.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def play_order() -> list[Column]:
    """Chronological order of actions: the clock counts down within a period."""
    return [F.col("game_id").asc(), F.col("period").asc(), F.col("clock_seconds").desc()]


def cell_ranks(df: DataFrame, columns: list[str], bits: int) -> list[Column]:
    """Each column's place among 2**bits ranges of about as many rows each, nulls in the first."""
    parts = 1 << bits
    cuts = df.agg(*[
        F.percentile_approx(c, [i / parts for i in range(1, parts)], 100 * parts).alias(str(i))
        for i, c in enumerate(columns)
    ]).first()

    def rank(name: str, found: list | None) -> Column:
        if not found:
            return F.lit(0)
        edges = F.array(*[F.lit(v) for v in sorted(set(found))])
        return F.coalesce(F.size(F.filter(edges, lambda edge: edge < F.col(name))), F.lit(0))

    return [rank(name, found) for name, found in zip(columns, cuts)]


def clustered_layout(df: DataFrame, columns: list[str], files: int, bits: int = 5) -> DataFrame:
    """Rows in ``files`` ranges of a Z-order over several numeric columns.

    A filter on any one of them then meets the value ranges of few files, where a sort by the first
    helps the first only. Ranges follow the quantiles of each column, so a skewed one is cut as
    finely as an even one, and rows of one cell are ranged by the columns themselves. Quantiles
    are all that reaches the driver, 2**bits a column.
    """
    ranks = cell_ranks(df, columns, bits)
    cell = F.lit(0).cast("bigint")
    for i, rank in enumerate(ranks):
        for bit in range(bits):
            digit = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            cell = cell + F.shiftleft(digit, bit * len(columns) + len(columns) - 1 - i)
    name = "_cell"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    placed = df.withColumn(name, cell)
    return placed.repartitionByRange(files, name, *columns).sortWithinPartitions(name, *columns).drop(name)


def range_shares(stored: DataFrame, columns: list[str]) -> DataFrame:
    """(filtered, n_rows, share): the share of files that a filter on one value of a column meets.

    It is the part of the column's whole range that a file's range takes up, averaged over files.
    """
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("_file")).agg(
        F.count("*").alias("_n"),
        *[f(c).alias(f"{name}_{i}") for i, c in enumerate(columns) for f, name in ((F.min, "low"), (F.max, "high"))])
    found = [
        F.struct(
            F.lit(c).alias("filtered"), F.sum("_n").alias("n_rows"),
            F.try_divide(F.avg(F.col(f"high_{i}") - F.col(f"low_{i}")),
                         F.max(f"high_{i}") - F.min(f"low_{i}")).alias("share"))
        for i, c in enumerate(columns)
    ]
    return ranges.agg(F.array(*found).alias("found")).select(F.inline("found"))
