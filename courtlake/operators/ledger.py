"""What became of every date, and what a run could not use.

Two tables beside the silver ones, both only ever appended to, one run at a time:

- the ledger says for each scope and date how it ended in a run. It is written last, after gold, so a
  run that is cut off leaves no trace in it and its dates are open as before;
- the rejects hold the documents, rows and files that a run left out, with the reason and the text.
  Those of a date's latest run count; earlier ones stay as history.

A date is ``done`` when all that was listed could be read and stored, ``open`` when it has no box score
yet, and ``failed`` when a document or a value stood in the way. Failed and open dates come
up again in every run until they are mended.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.session import compiled
from courtlake.sources.files import path_exists

LEDGER = "scope string, game_date date, state string, reason string, run string"
REJECTS = ("scope string, dataset string, file_key string, game_date date, row_pos bigint, reason string, "
           "fails boolean, text string, run string")
DATES, DIMENSIONS, MANIFESTS = "dates", "dimensions", "manifests"
DONE, OPEN, FAILED = "done", "open", "failed"


def new_run() -> str:
    """A name that sorts behind those of earlier runs."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def scan_ledger(spark: SparkSession, root: str) -> DataFrame:
    return _scan(spark, f"{root}/_ledger", LEDGER)


def scan_rejects(spark: SparkSession, root: str, run: str | None = None) -> DataFrame:
    rows = _scan(spark, f"{root}/_rejects", REJECTS)
    return rows if run is None else rows.where(F.col("run") == run)


def reject_rows(rows: DataFrame, scope: str, dataset: str | None, reason: Column, fails: bool, file_key: str = "file_key",
                game_date: str | None = "game_date", row_pos: str | None = None, text: str = "text") -> DataFrame:
    """Rows in the form of the rejects; ``fails`` says whether they fail their date.

    Without ``dataset`` the rows name their own.
    """
    as_column = lambda c: F.col(c) if c else F.lit(None).cast("string")
    return rows.select(
        F.lit(scope).alias("scope"), (F.lit(dataset) if dataset else F.col("dataset")).alias("dataset"), as_column(file_key).alias("file_key"),
        as_column(game_date).cast("date").alias("game_date"), as_column(row_pos).cast("bigint").alias("row_pos"),
        reason.alias("reason"), F.lit(fails).alias("fails"), as_column(text).alias("text"))


def keep_rejects(spark: SparkSession, root: str, run: str, frames: list[DataFrame]) -> None:
    for rows in frames:
        with compiled(rows.sparkSession):
            rows.withColumn("run", F.lit(run)).write.mode("append").parquet(f"{root}/_rejects")


def record(spark: SparkSession, root: str, run: str, outcomes: DataFrame) -> None:
    """Add ``outcomes(scope, game_date, state, reason)`` to the ledger."""
    rows = outcomes.select("scope", "game_date", "state", "reason", F.lit(run).alias("run"))
    rows.coalesce(1).write.mode("append").parquet(f"{root}/_ledger")


def date_outcomes(spark: SparkSession, root: str, run: str, dates: DataFrame, written: DataFrame) -> DataFrame:
    """How this run ended for each of ``dates``; ``written`` are the dates that have box scores."""
    first = F.min(F.concat_ws(" ", F.concat_ws("/", "dataset", "file_key"), "reason"))
    bad = scan_rejects(spark, root, run).where("fails").groupBy("game_date").agg(first.alias("reason"))
    has = written.select("game_date").distinct().withColumn("_written", F.lit(True))
    state = F.when(F.col("reason").isNotNull(), FAILED).when(F.col("_written"), DONE).otherwise(OPEN)
    return dates.select("game_date").distinct().join(bad, "game_date", "left").join(has, "game_date", "left").select(
        F.lit(DATES).alias("scope"), "game_date", state.alias("state"), "reason")


def latest(spark: SparkSession, root: str) -> DataFrame:
    """(scope, game_date, run, state, reason) of the latest run of each."""
    last = F.max(F.struct("run", "state", "reason")).alias("last")
    return scan_ledger(spark, root).groupBy("scope", "game_date").agg(last).select("scope", "game_date", "last.*")


def done_in_ledger(spark: SparkSession, root: str) -> DataFrame:
    return latest(spark, root).where((F.col("scope") == DATES) & (F.col("state") == DONE)).select("game_date")


def open_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The rejects that still stand: those of the latest run of their date, or of their scope."""
    last = latest(spark, root).select("scope", F.col("game_date").alias("_date"), F.col("run").alias("_run"))
    rows = scan_rejects(spark, root).withColumn(
        "_date", F.when(F.col("scope") == DATES, F.col("game_date")))
    same = (rows["scope"] == last["scope"]) & rows["_date"].eqNullSafe(last["_date"]) & (rows["run"] == last["_run"])
    return rows.join(last, same, "left_semi").drop("_date")
