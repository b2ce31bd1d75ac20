"""Parquet tables: silver partitions and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.functions.dates import season_of_date
from courtlake.sources.files import path_exists


def scan_silver(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """A whole date-partitioned silver dataset; an absent one is an empty table."""
    return scan_partitioned(spark, f"{root}/{dataset}", schemas.SILVER[dataset])


def scan_partitioned(spark: SparkSession, path: str, schema: str,
                     partitions: str = schemas.SILVER_PARTITIONS) -> DataFrame:
    full = f"{schema}, {partitions}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def only_date(df: DataFrame, day) -> DataFrame:
    """One date of a partitioned table: both partition columns prune folders."""
    d = F.lit(day).cast("date")
    return df.where((F.col("season") == season_of_date(d)) & (F.col("game_date") == d))


def only_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Several dates; the work list prunes partitions at run time."""
    return df.join(dates.select("game_date"), "game_date", "left_semi")


def scan_dim(spark: SparkSession, path: str) -> DataFrame:
    """An unpartitioned Parquet table."""
    return spark.read.parquet(path)
