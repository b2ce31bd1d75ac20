"""Raw documents to typed silver tables, for all dates of a work list at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtlake import schemas
from courtlake.functions.dates import parse_date, parse_date_lenient, season_of_date
from courtlake.functions.durations import clock_seconds
from courtlake.functions.numbers import (
    cast_int_strict, coerce_double, coerce_long, is_unsafe_long, truthy_bool, truthy_number,
)
from courtlake.functions.text import extras, strip_text
from courtlake.operators import ledger
from courtlake.operators.contracts import check_contract
from courtlake.operators.dedupe import keep_first
from courtlake.operators.flatten import flatten_sides, open_columns, player_columns
from courtlake.operators.sinks import stage_dim, switch_dim, write_partitioned
from courtlake.schemas import CONTRACT_SOURCES, CONTRACTS, DATASETS, SILVER, SILVER_KEYS
from courtlake.session import written_once
from courtlake.sources import documents
from courtlake.sources.documents import drop_failed_files, listed_games, on_list
from courtlake.sources.resultset import decode_resultset

PLACE = ["season", "game_date", "_manifest_pos", "_row_pos"]


@dataclass(frozen=True)
class Silver:
    """Typed rows per dataset, and the rows kept out for an id that is a fraction.

    ``bad`` counts the latter while ``rows`` are written, so that only datasets that
    have any are decoded again for them.
    """

    rows: dict[str, DataFrame]
    quarantine: dict[str, DataFrame]
    bad: dict[str, Observation]

    def rejects(self) -> list[DataFrame]:
        """The rows kept out, once ``rows`` have been written."""
        return [
            ledger.reject_rows(self.quarantine[d], ledger.DATES, d, F.lit("an id is no integer"), False,
                               file_key="GAME_ID", row_pos="_row_pos", text="_raw")
            for d, seen in self.bad.items() if seen.get["bad"]
        ]


def _placed(docs: DataFrame) -> list[Column]:
    return [
        season_of_date("game_date").alias("season"), F.col("game_date"),
        F.col("manifest_pos").alias("_manifest_pos"), F.col("_row_pos"),
    ]


def _any(conditions: list[Column]) -> Column:
    flag = F.lit(False)
    for condition in conditions:
        flag = flag | condition
    return flag


def _bad_row(bad: Column, fields: list[str]) -> list[Column]:
    """``_bad``, and for a bad row its fields as they came, in ``_raw``."""
    return [bad.alias("_bad"), F.when(bad, F.to_json(F.struct(*fields))).alias("_raw")]


def boxscore_rows(docs: DataFrame) -> DataFrame:
    """One row per player of listed box scores, with ``_bad`` for unusable ids."""
    players = flatten_sides(docs.select("game_id", "game_date", "manifest_pos", "boxScoreAdvanced"))
    base = player_columns()
    ids = ("PERSON_ID", "TEAM_ID")
    declared = list(base) + schemas.BOXSCORE_STATISTICS
    raw = players.select(
        "game_id", *_placed(docs), *[c.alias(n) for n, c in base.items()],
        *[F.col("statistics")[s].alias(s) for s in schemas.BOXSCORE_STATISTICS],
        extras("statistics", declared).alias("extras"),
    )
    numeric = [s for s in schemas.BOXSCORE_STATISTICS if s != "minutes"]
    return raw.select(
        *PLACE, F.col("game_id").alias("GAME_ID"),
        *[coerce_long(n).alias(n) if n in ids else F.col(n) for n in base],
        F.col("minutes"), *[coerce_double(n).alias(n) for n in numeric], "extras",
        *_bad_row(_any([is_unsafe_long(n) for n in ids]), list(base)),
    )


def action_rows(docs: DataFrame) -> DataFrame:
    """One row per action of listed play-by-play documents."""
    actions = docs.select(
        "game_id", "game_date", "manifest_pos",
        F.posexplode("game.actions").alias("_row_pos", "action"),
    )
    raw = open_columns(actions, "action", schemas.ACTION_FIELDS)
    longs = ("actionNumber", "period", "teamId", "personId", "scoreHome", "scoreAway")
    typed = {n: F.col(n) for n in schemas.ACTION_FIELDS}
    typed.update({n: coerce_long(n) for n in longs})
    typed["shotDistance"] = coerce_double("shotDistance")
    typed["isFieldGoal"] = truthy_number(coerce_double("isFieldGoal"))
    return raw.select(
        *_placed(docs), F.col("game_id").alias("GAME_ID"),
        *[c.alias(n) for n, c in typed.items()],
        clock_seconds("clock").alias("clock_seconds"), "extras",
        *_bad_row(_any([is_unsafe_long(n) for n in longs]), list(schemas.ACTION_FIELDS)),
    )


def shot_rows(docs: DataFrame) -> DataFrame:
    """One row per shot: the first result set of listed shot charts."""
    rows = decode_resultset(docs.select("game_id", "game_date", "manifest_pos", "resultSets"))
    names = [schemas.SHOT_DATE if h == "GAME_DATE" else h for h in schemas.SHOT_FIELDS]
    raw = rows.select(
        *_placed(docs), "game_id",
        *[F.col("row")[h].alias(n) for h, n in zip(schemas.SHOT_FIELDS, names)],
        # A payload's own GAME_ID gives way to the document key.
        extras("row", [*schemas.SHOT_FIELDS, "GAME_ID"]).alias("extras"),
        F.col("row").isNull().alias("_misfit"),
    )
    longs = ("GAME_EVENT_ID", "PLAYER_ID", "TEAM_ID", "PERIOD")
    typed = {n: F.col(n) for n in names}
    typed.update({n: coerce_long(n) for n in longs})
    typed.update({n: coerce_double(n) for n in ("SHOT_DISTANCE", "LOC_X", "LOC_Y")})
    typed.update({
        n: truthy_number(coerce_double(n)) for n in ("SHOT_ATTEMPTED_FLAG", "SHOT_MADE_FLAG")
    })
    typed[schemas.SHOT_DATE] = parse_date(schemas.SHOT_DATE)
    return raw.select(
        *PLACE, F.col("game_id").alias("GAME_ID"), *[c.alias(n) for n, c in typed.items()],
        "extras", *_bad_row(_any([F.col("_misfit"), *[is_unsafe_long(n) for n in longs]]), names),
    )


CONVERTERS = {"boxscores": boxscore_rows, "pbp": action_rows, "shot_chart": shot_rows}


def build_silver(entries: DataFrame, docs: dict[str, DataFrame], strict: bool = False) -> Silver:
    """Typed, de-duplicated rows of every listed document.

    ``entries`` holds (game_date, manifest_pos, game_id), ``docs`` the readable
    documents per dataset. A row whose id is a fraction goes to quarantine, or
    fails the query when ``strict``. The first row of a key within a game wins.
    """
    rows, quarantine, bad = {}, {}, {}
    listed = listed_games(entries)
    for dataset, convert in CONVERTERS.items():
        if dataset not in docs:
            continue
        converted = convert(on_list(docs[dataset], listed))
        quarantine[dataset] = converted.where("_bad").drop("_bad")
        if strict:
            message = F.concat(F.lit(f"{dataset}: an id of this game is no integer: "), "GAME_ID")
            checked = F.when(F.col("_bad"), F.raise_error(message).cast("boolean"))
            good = converted.where(F.coalesce(checked, F.lit(True))).drop("_bad", "_raw")
        else:
            bad[dataset] = Observation()
            observed = converted.drop("_raw").observe(bad[dataset], F.count_if("_bad").alias("bad"))
            good = observed.where(~F.col("_bad")).drop("_bad")
        # Rows are sorted by these: the game first, as nearly all rows differ in it.
        keys = [*SILVER_KEYS[dataset], "game_date", "season"]
        rows[dataset] = keep_first(good, keys, ["_manifest_pos", "_row_pos"])
    return Silver(rows, quarantine, bad)


def silver_layout(rows: DataFrame, dataset: str) -> DataFrame:
    """Column order of a stored silver dataset."""
    return rows.select(*StructType.fromDDL(SILVER[dataset]).names, "season", "game_date")


def write_silver(silver: Silver, root: str) -> None:
    """Replace the partitions of every date that has rows; other dates stay as they are."""
    for dataset, rows in silver.rows.items():
        write_partitioned(silver_layout(rows, dataset), f"{root}/{dataset}")


def validate_silver(rows: dict[str, DataFrame]) -> DataFrame:
    """Contract results of every game in every dataset, apart for each date it is listed on."""
    results = None
    for dataset in DATASETS:
        if dataset not in rows:
            continue
        checked = check_contract(
            rows[dataset], CONTRACTS[dataset], CONTRACT_SOURCES[dataset], group="GAME_ID",
            within=("game_date",),
        )
        results = checked if results is None else results.unionByName(checked)
    return results


# ---- dimension tables ----------------------------------------------------

def players_table(items: DataFrame) -> DataFrame:
    """Typed players; the first entry of an id wins. ``items`` carries ``_row_pos``."""
    typed = items.select(
        cast_int_strict("id").alias("id"),
        *[strip_text(c).alias(c) for c in ("full_name", "first_name", "last_name")],
        truthy_bool("is_active").alias("is_active"), "_row_pos",
    )
    return keep_first(typed, ["id"], ["_row_pos"]).drop("_row_pos")


def team_games_table(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed team histories, and (file_key, reason, text) of the files left out.

    ``docs`` holds (file_key, resultSets, _corrupt_record). A file fails as a
    whole when it is malformed, or a row of it does not fit its header, lacks an
    integer team id, or has a fraction where a count belongs. The first row of
    (GAME_ID, TEAM_ID) wins, in order of file name and row.
    """
    corrupt = F.col(documents.CORRUPT)
    unreadable = docs.where(corrupt.isNotNull() | F.get("resultSets", F.lit(0)).isNull()).select(
        "file_key", F.when(corrupt.isNotNull(), "malformed").otherwise("no result set").alias("reason"),
        corrupt.alias("text"))
    rows = decode_resultset(docs.where(F.col(documents.CORRUPT).isNull()).drop(documents.CORRUPT))
    counts = ["PTS", *schemas.TEAM_COUNT_FIELDS]
    headers = [
        "TEAM_ID", *schemas.TEAM_TEXT_FIELDS, "GAME_DATE", "PLUS_MINUS",
        *schemas.TEAM_PERCENT_FIELDS,
    ]
    # The many counts share one expression, applied to them as an array.
    texts = rows.select(
        "file_key", "_row_pos", *[F.col("row")[h].alias(h) for h in headers],
        F.array(*[F.col("row")[c] for c in counts]).alias("_texts"),
        F.col("row").isNull().alias("_misfit"),
    )
    failed = _any([
        F.col("_misfit"), F.col("TEAM_ID").try_cast("int").isNull(),
        F.exists("_texts", is_unsafe_long),
    ])
    # Typed once, rows that fail among them: both the table and the names of failed files read this copy.
    typed = texts.select(
        "file_key", F.coalesce(failed, F.lit(False)).alias("_failed"),
        F.col("TEAM_ID").try_cast("int").cast("bigint").alias("TEAM_ID"),
        *schemas.TEAM_TEXT_FIELDS, parse_date_lenient("GAME_DATE").alias("GAME_DATE"),
        *[coerce_double(c).alias(c) for c in ("PLUS_MINUS", *schemas.TEAM_PERCENT_FIELDS)],
        F.transform("_texts", coerce_long).alias("_counts"),
        F.col("file_key").alias("_file"), "_row_pos",
    ).select(
        "*", *[F.get("_counts", F.lit(i)).alias(c) for i, c in enumerate(counts)]
    ).drop("_counts")
    good, failed_files = drop_failed_files(
        written_once(docs.sparkSession, typed, "team-rows"), "file_key", F.col("_failed"))
    table = keep_first(good.drop("file_key"), ["GAME_ID", "TEAM_ID"], ["_file", "_row_pos"])
    rows_at_fault = failed_files.select(
        "file_key", F.lit("a row does not fit").alias("reason"), F.lit(None).cast("string").alias("text"))
    return table, unreadable.unionByName(rows_at_fault).distinct()


def scan_players(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Players of the one players file, in file order."""
    return documents.scan_json_array(
        spark, f"{bronze_root}/players/players.json", schemas.PLAYERS_DOC
    )


def build_dims_silver(spark: SparkSession, player_items: DataFrame, team_docs: DataFrame,
                      silver_root: str) -> DataFrame:
    """Write the players and team-history tables; returns their contract results.

    Players or a team history of which nothing can be read are an error, and then
    neither table changes: both are written beside the old ones and looked at first.
    """
    # The documents are decoded once; the table and the unreadable ones read the decoded ones.
    team_games, failed = team_games_table(written_once(spark, team_docs, "team-documents"))
    tables = {"players": players_table(player_items), "teams": team_games}
    staged = {name: stage_dim(rows, f"{silver_root}/{name}") for name, rows in tables.items()}
    for name, what in (("players", "player"), ("teams", "team history")):
        if spark.read.parquet(staged[name]).isEmpty():
            raise ValueError(f"no {what} could be read")
    for name, path in staged.items():
        switch_dim(spark, path, f"{silver_root}/{name}")
    run = ledger.new_run()
    ledger.keep_rejects(spark, silver_root, run, [ledger.reject_rows(
        failed, ledger.DIMENSIONS, "teams", F.col("reason"), True, game_date=None)])
    ledger.record(spark, silver_root, run, ledger.scan_rejects(spark, silver_root, run).agg(
        F.count("*").alias("n")).select(
        F.lit(ledger.DIMENSIONS).alias("scope"), F.lit(None).cast("date").alias("game_date"),
        F.when(F.col("n") > 0, ledger.FAILED).otherwise(ledger.DONE).alias("state"),
        F.when(F.col("n") > 0, F.concat("n", F.lit(" team files"))).alias("reason")))
    players, teams = (spark.read.parquet(f"{silver_root}/{t}") for t in ("players", "teams"))
    return check_contract(players, CONTRACTS["players"], "players").unionByName(
        check_contract(teams, CONTRACTS["teams"], "teams")
    )


def scan_dims(spark: SparkSession, bronze_root: str) -> tuple[DataFrame, DataFrame]:
    """(player items, team-history documents) of a raw lake."""
    return (
        scan_players(spark, bronze_root),
        documents.scan_result_sets(spark, f"{bronze_root}/teams"),
    )


RAW_DOCUMENTS = {
    "boxscores": schemas.BOXSCORE_DOC, "pbp": schemas.ACTIONS_DOC, "shot_chart": schemas.RESULT_SET_DOC,
}


def scan_quarantine(spark: SparkSession, bronze_root: str, entries: DataFrame,
                    datasets: list[str] | None = None) -> DataFrame:
    """(dataset, file_key, game_date, reason, text) of listed documents that can't be read."""
    listed = entries.groupBy("game_date", "game_id").agg(F.count("*").alias("_listed"))
    found = None
    for dataset in RAW_DOCUMENTS if datasets is None else datasets:
        docs = documents.scan_documents(spark, f"{bronze_root}/{dataset}", RAW_DOCUMENTS[dataset], entries)
        rows = unreadable_documents(docs, dataset, listed)
        found = rows if found is None else found.unionByName(rows)
    return found


def unreadable_documents(docs: DataFrame, dataset: str, entries: DataFrame) -> DataFrame:
    """(dataset, file_key, game_date, reason, text) of those that dates list."""
    bad = documents.split_corrupt(docs)[1]
    listed = entries.select("game_date", "game_id").distinct()
    return bad.join(listed, F.col("file_key") == F.col("game_id")).select(
        F.lit(dataset).alias("dataset"), "file_key", "game_date",
        F.lit("malformed").alias("reason"), F.col(documents.CORRUPT).alias("text"))


def scan_raw(spark: SparkSession, bronze_root: str, entries: DataFrame | None = None,
             corrupt: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Readable documents per dataset below a raw lake.

    With wanted games only their files are opened. ``corrupt``
    gets a count of the unreadable ones, which is known when the documents have been read.
    """
    found = {}
    for dataset, schema in RAW_DOCUMENTS.items():
        docs = documents.scan_documents(spark, f"{bronze_root}/{dataset}", schema, entries)
        if corrupt is not None:
            corrupt[dataset] = Observation()
            docs = docs.observe(corrupt[dataset], F.count(documents.CORRUPT).alias("n"))
        found[dataset] = documents.split_corrupt(docs)[0]
    return found
