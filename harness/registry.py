"""Registration of queries and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DATES = {"orders": "o_orderdate", "lineitem": "l_shipdate"}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` only its rows are checked."""

    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = function
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, its date column as a date."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in DATES:
        df = df.withColumn(DATES[name], F.col(DATES[name]).cast("date"))
    return df


def refused(df: DataFrame, message: str) -> int:
    """1 if computing ``df`` fails with an error that says ``message``, 0 if it succeeds."""
    try:
        df.write.format("noop").mode("overwrite").save()
    except PySparkException as error:
        if message not in str(error):
            raise
        return 1
    return 0
