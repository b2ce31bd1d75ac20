"""User-level jobs: process a set of dates, refresh dimensions, backfill a range, verify."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.functions.dates import date_range
from courtlake.operators import ledger, report, worklist
from courtlake.operators.contracts import empty_report, validation_report
from courtlake.operators.store import GoldStore, scan_gold
from courtlake.plans.gold import load_dimensions, load_facts, load_team_stats
from courtlake.plans.silver import (
    build_dims_silver, build_silver, scan_dims, scan_quarantine, scan_raw, validate_silver, write_silver,
)
from courtlake.schemas import DATASETS, DIMENSIONS, FACTS
from courtlake.session import reliable_checkpoint, written_once
from courtlake.sources.documents import (
    malformed_manifests, manifest_entries, require_manifests, scan_manifests, skip_no_game_days,
)
from courtlake.sources.tables import only_dates, scan_dim, scan_silver

DocumentsOf = Callable[[SparkSession, DataFrame], dict[str, DataFrame]]
#: (dataset, file_key, game_date, reason, text) of listed documents that can't be read; None for none.
UnreadableOf = Callable[[SparkSession, DataFrame], DataFrame | None]


class LakeDocuments:
    """Documents of listed games from the folders of a raw lake.

    While they are read the unreadable ones are counted, and only datasets
    that have any are read again for them.
    """

    def __init__(self, bronze_root: str):
        self.bronze_root = bronze_root
        self._corrupt: dict = {}

    def __call__(self, spark: SparkSession, entries: DataFrame) -> dict[str, DataFrame]:
        self._corrupt = {}
        return scan_raw(spark, self.bronze_root, entries, self._corrupt)

    def unreadable(self, spark: SparkSession, entries: DataFrame) -> DataFrame | None:
        """To be asked once the documents of the last call have been read."""
        found = [dataset for dataset, seen in self._corrupt.items() if seen.get["n"]]
        return scan_quarantine(spark, self.bronze_root, entries, found) if found else None


def lake_documents(bronze_root: str) -> LakeDocuments:
    return LakeDocuments(bronze_root)


def process_dates(spark: SparkSession, entries: DataFrame, docs: dict[str, DataFrame],
                  silver_root: str, store: GoldStore, unreadable_of: UnreadableOf | None = None,
                  run: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw documents -> silver -> gold for all listed games at once.

    What can't be used is kept in the rejects: documents that can't be read, rows with unusable ids,
    values that gold can't store. The rest is loaded. The ledger, written last, says which
    dates are done (see :mod:`courtlake.operators.ledger`). Returns (contract results, load counts).
    """
    run = run or ledger.new_run()
    built = build_silver(entries, docs)
    write_silver(built, silver_root)
    rejects = built.rejects()
    bad = unreadable_of(spark, entries) if unreadable_of else None
    if bad is not None:
        rejects.append(ledger.reject_rows(bad, ledger.DATES, None, F.col("reason"), True))
    ledger.keep_rejects(spark, silver_root, run, rejects)
    dates = reliable_checkpoint(spark, entries.select("game_date").distinct())
    silver = silver_of_dates(spark, silver_root, dates)
    later = later_silver(spark, silver_root, dates)
    unfit: dict[str, list[DataFrame]] = {}
    counts = load_facts(spark, store, silver, later, unfit)
    ledger.keep_rejects(spark, silver_root, run, [
        ledger.reject_rows(rows, ledger.DATES, table, F.col("_reason"), True, file_key="game_id",
                           row_pos="_row_pos", text="_raw")
        for table, found in unfit.items() for rows in found])
    outcomes = ledger.date_outcomes(spark, silver_root, run, dates, worklist.silver_dates(spark, silver_root))
    ledger.record(spark, silver_root, run, outcomes)
    return validate_silver(silver), counts


def keep_manifests_rejects(spark: SparkSession, silver_root: str, bad: DataFrame) -> None:
    """Keep ``bad(file_key, text)``, manifests that can't be read, as a run of their own."""
    run = ledger.new_run()
    ledger.keep_rejects(spark, silver_root, run, [ledger.reject_rows(
        bad, ledger.MANIFESTS, "manifests", F.lit("malformed"), True, game_date=None)])
    n = ledger.scan_rejects(spark, silver_root, run).count()
    ledger.record(spark, silver_root, run, spark.createDataFrame(
        [(ledger.MANIFESTS, None, ledger.FAILED if n else ledger.DONE, f"{n} manifests" if n else None)],
        "scope string, game_date date, state string, reason string"))


def later_silver(spark: SparkSession, silver_root: str, entries: DataFrame) -> dict[str, DataFrame] | None:
    """Stored silver rows of dates after the first listed one that are not listed; None without any.

    None is the rule: such dates exist when a date arrives after a later one.
    """
    dates = entries.select("game_date").distinct()
    first = dates.agg(F.min("game_date").alias("first"))
    after = worklist.silver_dates(spark, silver_root).join(first, F.col("game_date") > F.col("first")).join(
        dates, "game_date", "left_anti").select("game_date")
    if after.isEmpty():
        return None
    return silver_of_dates(spark, silver_root, after)


def silver_of_dates(spark: SparkSession, silver_root: str, entries: DataFrame) -> dict[str, DataFrame]:
    """Stored silver rows of the listed dates."""
    dates = entries.select("game_date").distinct()
    # The range prunes folders when the scan is planned, the join drops gaps in it.
    span = dates.agg(F.min("game_date").alias("first"), F.max("game_date").alias("last")).first()
    return {
        dataset: only_dates(
            scan_silver(spark, silver_root, dataset).where(
                F.col("game_date").between(F.lit(span["first"]), F.lit(span["last"]))
            ),
            dates,
        )
        for dataset in DATASETS
    }


def load_dates(spark: SparkSession, silver_root: str, store: GoldStore, manifests: DataFrame,
               dates: DataFrame) -> DataFrame | None:
    """Gold only: load the stored silver rows of these dates; returns the load counts.

    A date whose manifest is empty loads nothing; one without a manifest is loaded
    from what silver holds. None when no date is left.
    """
    listed = manifests.groupBy("game_date").agg(F.sum(F.size("game_ids")).alias("n"))
    wanted = dates.select("game_date").distinct().join(
        listed.where("n = 0"), "game_date", "left_anti")
    wanted = reliable_checkpoint(
        spark, wanted.join(worklist.silver_dates(spark, silver_root), "game_date", "left_semi"))
    if wanted.isEmpty():
        return None
    later = later_silver(spark, silver_root, wanted)
    return load_facts(spark, store, silver_of_dates(spark, silver_root, wanted), later)


def process_date(spark: SparkSession, manifests: DataFrame, documents_of: DocumentsOf,
                 silver_root: str, store: GoldStore, day) -> tuple[DataFrame, DataFrame] | None:
    """One date; without a manifest it fails, without games there is nothing to do."""
    wanted = spark.range(1).select(F.lit(day).cast("date").alias("game_date"))
    # The manifests of the date are taken out of all others once.
    found = written_once(spark, manifests.join(wanted, "game_date", "left_semi"), "manifests")
    entries = manifest_entries(skip_no_game_days(require_manifests(wanted, found)))
    if entries.isEmpty():
        return None
    return process_dates(spark, entries, documents_of(spark, entries), silver_root, store,
                         getattr(documents_of, "unreadable", None))


def refresh_dimensions(spark: SparkSession, player_items: DataFrame, team_docs: DataFrame,
                       silver_root: str, store: GoldStore) -> tuple[DataFrame, DataFrame]:
    """All dimensions and the team fact; returns (contract results, load counts).

    Dimensions come first, because facts are checked against them.
    """
    results = build_dims_silver(spark, player_items, team_docs, silver_root)
    players = scan_dim(spark, f"{silver_root}/players")
    team_games = scan_dim(spark, f"{silver_root}/teams")
    counts = load_dimensions(store, players, team_games)
    return results, counts.unionByName(load_team_stats(store, team_games))


def refresh_lake(spark: SparkSession, bronze_root: str, silver_root: str, store: GoldStore,
                 day: str) -> DataFrame:
    """The weekly job on a raw lake: dimensions, team fact, then one date's facts."""
    results, _ = refresh_dimensions(spark, *scan_dims(spark, bronze_root), silver_root, store)
    manifests = scan_manifests(spark, f"{bronze_root}/manifests")
    loaded = process_date(spark, manifests, lake_documents(bronze_root), silver_root, store, day)
    return results if loaded is None else results.unionByName(loaded[0])


def plan_backfill(dates: DataFrame, manifests: DataFrame, written: DataFrame,
                  force: bool = False) -> DataFrame:
    """(game_date, status) of every date of a range before the run.

    ``skipped`` is done already, ``failed`` has no manifest to work from, and
    ``processed`` is what the run will do.
    """
    pending = worklist.pending_dates(dates, manifests, written, force)
    listed = manifests.select("game_date").distinct().withColumn("_listed", F.lit(True))
    todo = pending.join(listed, "game_date", "left").select(
        "game_date", F.when(F.col("_listed"), "processed").otherwise("failed").alias("status")
    )
    return dates.select("game_date").distinct().join(todo, "game_date", "left").select(
        "game_date", F.coalesce("status", F.lit("skipped")).alias("status")
    )


def backfill(spark: SparkSession, manifests: DataFrame, documents_of: DocumentsOf,
             silver_root: str, store: GoldStore, dates: DataFrame, force: bool = False,
             unreadable_of: UnreadableOf | None = None) -> tuple[DataFrame, DataFrame | None]:
    """All pending dates of a range in one batch; returns (summary, contract results)."""
    statuses, results = backfill_dates(spark, manifests, documents_of, silver_root, store, dates, force, unreadable_of)
    return worklist.backfill_summary(statuses), results


def backfill_dates(spark: SparkSession, manifests: DataFrame, documents_of: DocumentsOf,
                   silver_root: str, store: GoldStore, dates: DataFrame, force: bool = False,
                   unreadable_of: UnreadableOf | None = None) -> tuple[DataFrame, DataFrame | None]:
    """As :func:`backfill`, with (game_date, status) of every date in place of the summary.

    A date is done when the ledger says so or its manifest is empty. Dates of which
    something could not be read or stored count as failed, in this run and in every later one
    until they are mended, while what could be used of them is loaded. The results
    are None when no pending date has games.
    """
    # They are asked for dates, games and an order; where they come from may be much work.
    manifests = written_once(spark, manifests, "manifests")
    statuses = reliable_checkpoint(
        spark, plan_backfill(dates, manifests, ledger.done_in_ledger(spark, silver_root), force))
    work = manifests.join(
        statuses.where("status = 'processed'").select("game_date"), "game_date", "left_semi"
    )
    entries = manifest_entries(skip_no_game_days(work))
    if entries.isEmpty():
        return statuses, None
    run = ledger.new_run()
    results, _ = process_dates(spark, entries, documents_of(spark, entries), silver_root, store,
                               unreadable_of or getattr(documents_of, "unreadable", None), run)
    mine = (F.col("run") == run) & (F.col("state") == ledger.FAILED)
    failed = ledger.scan_ledger(spark, silver_root).where(mine).select(
        "game_date", F.lit(True).alias("_failed"))
    return statuses.join(failed, "game_date", "left").select(
        "game_date", F.when(F.col("_failed"), "failed").otherwise(F.col("status")).alias("status")), results


def backfill_lake(spark: SparkSession, bronze_root: str, silver_root: str, store: GoldStore,
                  start: str, end: str, force: bool = False, load_dims: bool = False,
                  ) -> tuple[DataFrame, DataFrame]:
    """Backfill of a raw lake; returns (summary, validation report).

    ``load_dims`` loads players and teams first, but not games or the team fact.
    """
    checked = []
    if load_dims:
        checked.append(build_dims_silver(spark, *scan_dims(spark, bronze_root), silver_root))
        load_dimensions(
            store, scan_dim(spark, f"{silver_root}/players"),
            scan_dim(spark, f"{silver_root}/teams"), with_games=False,
        )
    keep_manifests_rejects(spark, silver_root, malformed_manifests(spark, f"{bronze_root}/manifests"))
    summary, results = backfill(
        spark, scan_manifests(spark, f"{bronze_root}/manifests"), lake_documents(bronze_root),
        silver_root, store, date_range(spark, start, end), force,
    )
    if results is not None:
        checked.append(results)
    return summary, validation_report(*checked) if checked else empty_report(spark)


def verify(store: GoldStore, dates: DataFrame) -> dict[str, DataFrame]:
    """Row counts of all tables, a breakdown per date, and two random samples."""
    tables = {name: scan_gold(store, name) for name in [*DIMENSIONS, *FACTS]}
    played = tables["fact_player_stats"].where("minutes > 0")
    told = tables["fact_play_by_play"].where("description != ''")
    return {
        "counts": report.table_counts(tables),
        "breakdown": report.date_breakdown(dates, tables["games"], {
            "player_stats": tables["fact_player_stats"],
            "play_by_play": tables["fact_play_by_play"],
            "shots": tables["fact_shots"],
        }),
        "player_sample": report.random_sample(
            played.select("game_id", "player_id", "off_rating", "ts_pct", "minutes")
        ),
        "play_sample": report.random_sample(
            told.select("game_id", "period", "clock_seconds", "action_type", "description")
        ),
    }
