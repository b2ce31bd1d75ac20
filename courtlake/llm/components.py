"""Connected components of a graph whose links are rows: alternating star contraction.

Every round works on the links as tables (joins and grouped minima); nothing is gathered in one
task. Each grouped minimum is written before it is joined, so that both sides of the join are
plain shuffles and Spark can split the rows of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.llm.common import saved


def _hung(spark: SparkSession, directed: DataFrame, above: bool, name: str) -> DataFrame:
    """Hang the neighbours ``v`` of each ``u`` onto the smallest of them and ``u``.

    ``above``: only neighbours larger than ``u`` move; else ``u`` itself moves with the smaller ones.
    """
    least = saved(
        spark,
        directed.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")),
        f"{name}-least",
    )
    moved = directed.join(least, "u")
    if above:
        links = moved.where("v > u").select("v", "m")
    else:
        links = moved.select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return links.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _print(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(spark: SparkSession, links: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``; the root is the component's smallest node.

    Loops, repeated and reversed links do no harm; a null at either end drops the link. An empty
    table gives an empty one.
    """
    edges = saved(
        spark,
        links.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        name,
    )
    before = _print(edges)
    while before[0]:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = saved(spark, _hung(spark, both, True, name), f"{name}-large")
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        edges = saved(spark, _hung(spark, down, False, name), name)
        after = _print(edges)
        if after == before:
            break
        before = after
    star = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.union(star.select(F.col("root").alias("node"), "root").distinct())
