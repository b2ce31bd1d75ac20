"""Work lists: what is there, what is missing, what was done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.sources.documents import document_keys, skip_no_game_days
from courtlake.sources.files import child_names

# A manifest longer than this is written as several numbered parts, so no task
# ever holds the ids of a whole date when a date is very large.
MANIFEST_PART_SIZE = 10_000


def build_manifests(dates: DataFrame, ids: DataFrame, part_size: int = MANIFEST_PART_SIZE) -> DataFrame:
    """(game_date, first_pos, game_ids): ids in their order, an empty list for a day without games.

    ``ids`` holds (game_date, pos, game_id) with positions counted per date. Each
    part says where it starts, so that parts of any size can be read together.
    """
    parts = ids.groupBy(
        "game_date", F.floor(F.col("pos") / F.lit(part_size)).alias("_part")
    ).agg(F.array_sort(F.collect_list(F.struct("pos", "game_id"))).alias("_ids"))
    return dates.select("game_date").join(parts, "game_date", "left").select(
        "game_date",
        F.coalesce(F.get("_ids.pos", F.lit(0)), F.lit(0)).cast("bigint").alias("first_pos"),
        F.coalesce(F.col("_ids.game_id"), F.array()).alias("game_ids"),
    )


def write_manifests(manifests: DataFrame, path: str) -> None:
    """JSON lines, one object per manifest part."""
    text = manifests.withColumn("game_date", F.date_format("game_date", "yyyy-MM-dd"))
    text.write.mode("overwrite").json(path)


def silver_dates(spark: SparkSession, silver_root: str, dataset: str = "boxscores") -> DataFrame:
    """Dates that have a partition of a silver dataset, from the folder names alone."""
    found = [
        (name.split("=", 1)[1],)
        for season in child_names(spark, f"{silver_root}/{dataset}") if season.startswith("season=")
        for name in child_names(spark, f"{silver_root}/{dataset}/{season}")
        if name.startswith("game_date=")
    ]
    return spark.createDataFrame(found, "game_date string").select(
        F.col("game_date").cast("date").alias("game_date")
    )


def done_dates(manifests: DataFrame, written: DataFrame) -> DataFrame:
    """Dates with nothing left to do.

    A date whose manifest is empty is done; a date with games is done once its
    box scores are written; a date without a manifest is not.
    """
    with_games = skip_no_game_days(manifests).select("game_date").distinct()
    empty = manifests.select("game_date").distinct().join(with_games, "game_date", "left_anti")
    return empty.unionByName(with_games.join(written, "game_date", "left_semi"))


def pending_dates(dates: DataFrame, manifests: DataFrame, written: DataFrame,
                  force: bool = False) -> DataFrame:
    """Dates still to be processed (all of them when forced)."""
    wanted = dates.select("game_date").distinct()
    return wanted if force else except_done(wanted, done_dates(manifests, written))


def except_done(dates: DataFrame, done: DataFrame) -> DataFrame:
    return dates.join(done, "game_date", "left_anti")


def missing_documents(entries: DataFrame, present: DataFrame,
                      datasets: list[str] = schemas.DATASETS) -> DataFrame:
    """(game_id, dataset) pairs on a manifest without a raw document."""
    wanted = entries.select("game_id").distinct().select(
        "game_id", F.explode(F.array(*[F.lit(d) for d in datasets])).alias("dataset")
    )
    return wanted.join(present.select("game_id", "dataset"), ["game_id", "dataset"], "left_anti")


def present_documents(spark: SparkSession, bronze_root: str,
                      datasets: list[str] = schemas.DATASETS) -> DataFrame:
    """(game_id, dataset) of every raw document of a lake."""
    found = None
    for dataset in datasets:
        keys = document_keys(spark, f"{bronze_root}/{dataset}").select(
            F.col("file_key").alias("game_id"), F.lit(dataset).alias("dataset")
        )
        found = keys if found is None else found.unionByName(keys)
    return found


def first_n(df: DataFrame, order: str, n: int = 30) -> DataFrame:
    """The first n rows in order (a top-n, not a full sort)."""
    return df.orderBy(order).limit(n)


def backfill_summary(statuses: DataFrame, listed: int = 30) -> DataFrame:
    """One row: total, processed, skipped, failed, and the first failed dates as text.

    ``statuses`` holds (game_date, status).
    """
    counts = statuses.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("processed", "skipped", "failed")],
    )
    # Only the listed dates are ever gathered.
    failed = first_n(statuses.where("status = 'failed'").select("game_date"), "game_date", listed)
    names = failed.agg(
        F.array_join(F.array_sort(F.collect_list(F.col("game_date").cast("string"))), ", ")
        .alias("failed_dates")
    )
    # Two one-row tables side by side.
    return counts.withColumn("_one", F.lit(1)).join(names.withColumn("_one", F.lit(1)), "_one").drop("_one")
