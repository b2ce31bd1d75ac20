"""Silver tables to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake.functions.dates import season_of_date, season_of_id
from courtlake.functions.durations import decimal_minutes
from courtlake.functions.numbers import coerce_double, zero_to_null
from courtlake.operators.dedupe import drop_null_key, keep_first
from courtlake.operators.flatten import conform
from courtlake.operators.store import (
    AGAIN, AS_OF, GoldStore, append_absent, brought_by, date_back, merge_table, references_of, typed_store,
)
from courtlake.operators.refs import fk_rejects
from courtlake.schemas import FACT_DATASETS, GOLD, GOLD_FROM_SILVER
from courtlake.session import written_once

IN_ORDER = ["game_date", "_manifest_pos", "_row_pos"]


# ---- dimensions ----------------------------------------------------------

def players_dimension(players: DataFrame) -> DataFrame:
    """Players are unique by id already; a repeated id keeps one of equal rows."""
    conformed = conform(players, GOLD_FROM_SILVER["players"])
    return keep_first(conformed, ["player_id"], ["first_name", "last_name", "is_active"])


def teams_dimension(team_games: DataFrame) -> DataFrame:
    """The first name a team appears under."""
    conformed = conform(team_games, GOLD_FROM_SILVER["teams"], keep=["_file", "_row_pos"])
    return keep_first(conformed, ["id"], ["_file", "_row_pos"]).drop("_file", "_row_pos")


def games_dimension(team_games: DataFrame) -> DataFrame:
    conformed = conform(team_games, GOLD_FROM_SILVER["games"], keep=["_file", "_row_pos"])
    first = keep_first(conformed, ["game_id"], ["_file", "_row_pos"]).drop("_file", "_row_pos")
    return first.withColumn("season_id", season_of_id("season_id"))


def dimension_stubs(boxscores: DataFrame) -> dict[str, DataFrame]:
    """Dimension rows implied by box scores, one per key: the earliest date's wins.

    Each carries ``since``, the date that first brought it.
    """
    first_date = F.col("game_date").alias("since")
    # Of a game only the date is kept, so no row needs its place in an order. No date comes before all others.
    dated = F.when(F.count_if(F.col("game_date").isNull()) == 0, F.min("game_date"))
    games = drop_null_key(boxscores, ["GAME_ID"]).groupBy("GAME_ID").agg(dated.alias("game_date")).select(
        F.col("GAME_ID").alias("game_id"),
        season_of_date("game_date").alias("season_id"), "game_date", first_date,
    )
    players = keep_first(drop_null_key(boxscores, ["PERSON_ID"]), ["PERSON_ID"], IN_ORDER).select(
        F.col("PERSON_ID").alias("player_id"), F.col("FIRST_NAME").alias("first_name"),
        F.col("FAMILY_NAME").alias("last_name"), F.lit(True).alias("is_active"), first_date,
    )
    teams = keep_first(drop_null_key(boxscores, ["TEAM_ID"]), ["TEAM_ID"], IN_ORDER).select(
        F.col("TEAM_ID").alias("id"), *stub_name("TEAM_TRICODE"), first_date,
    )
    return {"games": games, "players": players, "teams": teams}


def stub_name(column: str) -> list:
    """A stub team is called by its abbreviation."""
    return [F.col(column).alias("abbreviation"), F.col(column).alias("team_name")]


# ---- facts ---------------------------------------------------------------

def fact_rows(silver: DataFrame, table: str) -> DataFrame:
    """A fact of dated silver rows in gold columns, with the order columns kept."""
    rows = conform(silver, GOLD_FROM_SILVER[table], keep=IN_ORDER)
    if table == "fact_player_stats":
        return rows.withColumn("minutes", decimal_minutes("minutes"))
    if table == "fact_play_by_play":
        return rows.withColumns({c: zero_to_null(c) for c in ("team_id", "player_id")})
    return rows


def last_load(rows: DataFrame, table: str) -> DataFrame:
    """One row per key: the latest date's, and within a date the first."""
    order = [F.col("game_date").desc(), F.col("_manifest_pos"), F.col("_row_pos")]
    return keep_first(rows, list(GOLD[table].primary_key), order)


def team_fact_rows(team_games: DataFrame) -> DataFrame:
    rows = conform(team_games, GOLD_FROM_SILVER["fact_team_stats"], keep=["_file", "_row_pos"])
    first = keep_first(rows, ["game_id", "team_id"], ["_file", "_row_pos"])
    return first.drop("_file", "_row_pos").withColumn("minutes", coerce_double("minutes"))


# ---- loads into a store --------------------------------------------------

def load_dimensions(store: GoldStore, players: DataFrame | None, team_games: DataFrame | None,
                    with_games: bool = True) -> DataFrame:
    """Upsert the dimensions; returns the counts of each."""
    sources = {}
    if team_games is not None:
        sources["teams"] = teams_dimension(team_games)
    if players is not None:
        sources["players"] = players_dimension(players)
    if team_games is not None and with_games:
        sources["games"] = games_dimension(team_games)
    return _counts([merge_table(store, table, rows) for table, rows in sources.items()])


def load_team_stats(store: GoldStore, team_games: DataFrame) -> DataFrame:
    return merge_table(store, "fact_team_stats", team_fact_rows(team_games))


def load_facts(spark: SparkSession, store: GoldStore, silver: dict[str, DataFrame],
               later: dict[str, DataFrame] | None = None,
               rejects: dict[str, list[DataFrame]] | None = None) -> DataFrame:
    """Stub dimensions, then the three dated facts, for all dates in ``silver``.

    The result does not depend on how dates are batched, in which order they are
    loaded, or how often: a stub comes from its earliest date, a fact from its
    latest, and a fact does not see a stub that only a later date brings. Both
    dates are stored with the rows. ``later`` holds silver rows of dates that are
    loaded already and come after the first of these: those that were left out and refer to a
    stub of the present dates are tried again; the counts are those of the present dates.
    ``rejects`` gets the rows whose values can't be stored, per table (see :func:`merge_table`).
    """
    seen_again: dict[str, DataFrame] = {}
    if "boxscores" in silver:
        dates = silver["boxscores"].select("game_date").distinct()
        for table, stubs in dimension_stubs(silver["boxscores"]).items():
            # Fixed before the append, after which the stubs are known keys.
            stubs = written_once(spark, stubs, f"stubs-{table}")
            append_absent(store, table, stubs, unique=True)
            if later:
                date_back(store, table, stubs)
                seen_again[table] = brought_by(store, table, dates)
    counts = []
    for table, dataset in FACT_DATASETS.items():
        if dataset in silver:
            rows = fact_rows(silver[dataset], table)
            if seen_again and later and dataset in later:
                missed = _not_held(store, table, fact_rows(later[dataset], table))
                retried = _referring(missed, table, seen_again)
                rows = rows.withColumn(AGAIN, F.lit(False)).unionByName(retried.withColumn(AGAIN, F.lit(True)))
            unfit = None if rejects is None else rejects.setdefault(table, [])
            counts.append(load_fact(store, table, rows, unfit))
    return _counts(counts)


def _not_held(store: GoldStore, table: str, rows: DataFrame) -> DataFrame:
    """Rows of a fact but those whose key it holds from their date or a later one.

    Silver has one row for a key and date, so a merge of such a row changes nothing.
    """
    keys = GOLD[table].primary_key
    held = store.snapshots(table).scan().select(
        *[F.col(k).alias(f"_held_{k}") for k in keys], F.col(AS_OF).alias("_held_from"))
    same = F.col("_held_from") >= F.col("game_date")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_held_{k}"))
    return rows.join(held, same, "left_anti")


def _referring(rows: DataFrame, table: str, brought: dict[str, DataFrame]) -> DataFrame:
    """Rows of a fact, on or after its date, that refer to one of these dimension rows."""
    found = []
    for column, dimension, key in GOLD[table].references:
        if dimension in brought:
            # A dimension has one row for each key, so no row of the fact is doubled.
            keys = brought[dimension].select(F.col(key).alias("_brought"), F.col("since").alias("_since"))
            rows = rows.join(keys, (F.col(column) == F.col("_brought")) & (F.col("_since") <= F.col("game_date")), "left")
            found.append(f"_hit_{dimension}")
            rows = rows.withColumn(found[-1], F.col("_brought").isNotNull()).drop("_brought", "_since")
    if not found:
        return rows.limit(0)
    return rows.where(" or ".join(found)).drop(*found)


def fact_rejects(store: GoldStore, table: str, silver: DataFrame) -> DataFrame:
    """(table, fk, key, n): the rows of a dated fact that a load leaves out, by the key they miss."""
    rows = typed_store(fact_rows(silver, table), GOLD[table])
    return fk_rejects(rows, references_of(store, table, dated=True), table)


def load_fact(store: GoldStore, table: str, rows: DataFrame,
              rejects: list[DataFrame] | None = None) -> DataFrame:
    return merge_table(store, table, rows, reduce=lambda kept: last_load(kept, table), rejects=rejects,
                       unique=True)


def _counts(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
