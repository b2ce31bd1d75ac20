"""Data contracts over the given tables and over the derived documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.operators import contracts
from courtlake.plans import silver
from courtlake.schemas import CONTRACT_SOURCES, CONTRACTS, Contract
from harness import raw
from harness.document_queries import SILVER_SQL
from harness.registry import query, table
from harness.table_queries import lines

ISSUE_TYPES = """
source, seq::INT AS seq, "check", "column", n_bad::BIGINT AS n_bad, n_total::BIGINT AS n_total,
bound::VARCHAR AS bound, message"""


def _lines(spark, sf_dir):
    """Line items with a null team for supplier 0 and NaN on line 7."""
    return lines(spark, sf_dir).select(
        *["l_orderkey", "l_linenumber", "l_returnflag"],
        F.nullif("l_suppkey", F.lit(0)).alias("team_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
        .alias("quantity"),
    )


@query("check_pk_unique", f"""
WITH c AS (SELECT l_returnflag AS f, count(*) AS n_total,
                  count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_bad FROM lineitem GROUP BY ALL),
r AS (SELECT 'lineitem/' || f AS source, 0 AS seq, 'pk_unique' AS "check", 'l_orderkey,l_linenumber' AS "column",
             n_bad, n_total, NULL AS bound,
             'DUPLICATE PK: ' || n_bad || ' rows on [''l_orderkey'', ''l_linenumber'']' AS message FROM c)
SELECT {ISSUE_TYPES} FROM r
""")
def check_pk_unique(spark, sf_dir):
    return contracts.all_checks(contracts.check_pk_unique(
        _lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "lineitem", "l_returnflag"
    ))


@query("check_not_null", f"""
WITH c AS (SELECT l_returnflag AS f, count(*) AS n_total, count(*) FILTER (WHERE l_suppkey = 0) AS nulls,
                  count(*) FILTER (WHERE l_linenumber = 7) AS nans FROM lineitem GROUP BY ALL),
r AS (
  SELECT 'lineitem/' || f AS source, 0 AS seq, 'not_null' AS "check", 'team_id' AS "column", nulls AS n_bad,
         n_total, NULL AS bound, 'NULL: team_id has ' || nulls || '/' || n_total || ' nulls' AS message FROM c
  UNION ALL
  SELECT 'lineitem/' || f, 1, 'not_null', 'quantity', nans, n_total, NULL,
         'NULL: quantity has ' || nans || '/' || n_total || ' nulls' FROM c
  UNION ALL SELECT 'lineitem/' || f, 2, 'missing_column', 'wl', 1, n_total, NULL, 'MISSING COLUMN: wl' FROM c)
SELECT {ISSUE_TYPES} FROM r
""")
def check_not_null(spark, sf_dir):
    return contracts.all_checks(contracts.check_not_null(
        _lines(spark, sf_dir), ["team_id", "quantity", "wl"], "lineitem", "l_returnflag"
    ))


@query("check_range", f"""
WITH c AS (SELECT l_returnflag AS f, count(*) AS n_total,
                  count(*) FILTER (WHERE l_linenumber <> 7 AND l_quantity < 5) AS low,
                  count(*) FILTER (WHERE l_linenumber <> 7 AND l_quantity > 45) AS high FROM lineitem GROUP BY ALL),
r AS (
  SELECT 'lineitem/' || f AS source, 0 AS seq, 'range_below' AS "check", 'quantity' AS "column", low AS n_bad,
         n_total, '5' AS bound, 'RANGE: quantity has ' || low || ' values below 5' AS message FROM c
  UNION ALL
  SELECT 'lineitem/' || f, 1, 'range_above', 'quantity', high, n_total, '45',
         'RANGE: quantity has ' || high || ' values above 45' FROM c)
SELECT {ISSUE_TYPES} FROM r
""")
def check_range(spark, sf_dir):
    return contracts.all_checks(contracts.check_range(
        _lines(spark, sf_dir), "quantity", 5, 45, "lineitem", "l_returnflag"
    ))


@query("check_min_rows", f"""
WITH c AS (SELECT l_returnflag AS f, count(*) AS n_total FROM lineitem GROUP BY ALL),
r AS (SELECT 'lineitem/' || f AS source, 0 AS seq, 'min_rows' AS "check", NULL::VARCHAR AS "column",
             greatest(0, 1000000 - n_total) AS n_bad, n_total, '1000000' AS bound,
             'ROW COUNT: ' || n_total || ' rows (expected ≥1000000)' AS message FROM c)
SELECT {ISSUE_TYPES} FROM r
""")
def check_min_rows(spark, sf_dir):
    return contracts.all_checks(contracts.check_min_rows(
        _lines(spark, sf_dir), 1_000_000, "lineitem", "l_returnflag"
    ))


@query("pct_null", """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_suppkey = 0) AS a,
                  count(*) FILTER (WHERE l_linenumber = 7) AS b FROM lineitem)
SELECT 'team_id' AS "column", a AS n_null, n AS n_total, a * 100.0::DOUBLE / n AS pct_null FROM c
UNION ALL SELECT 'quantity', b, n, b * 100.0::DOUBLE / n FROM c
""")
def pct_null(spark, sf_dir):
    return contracts.pct_null(_lines(spark, sf_dir), ["team_id", "quantity"])


@query("conditional_counts", """
SELECT l_returnflag, count(*) FILTER (WHERE l_suppkey = 0) AS n_null, count(*) FILTER (WHERE l_quantity < 5) AS n_low,
       count(*) FILTER (WHERE l_quantity > 60) AS n_high, bool_or(l_suppkey = 0) AS any_null,
       bool_or(l_quantity < 5) AS any_low, bool_or(l_quantity > 60) AS any_high
FROM lineitem GROUP BY ALL
""")
def conditional_counts(spark, sf_dir):
    return contracts.conditional_counts(lines(spark, sf_dir), {
        "null": F.nullif("l_suppkey", F.lit(0)).isNull(),
        "low": F.col("l_quantity") < 5, "high": F.col("l_quantity") > 60,
    }, by=["l_returnflag"])


def game_results(spark, sf_dir, dataset):
    docs = {dataset: raw.documents(spark, sf_dir, dataset)}
    rows = silver.build_silver(raw.entries(spark, sf_dir), docs).rows[dataset]
    return contracts.check_contract(
        rows, CONTRACTS[dataset], CONTRACT_SOURCES[dataset], group="GAME_ID"
    )


def _range(seq: int, column: str, n_bad: str, side: str, bound: int, n_total: int, source: str, rows: str) -> str:
    """Issue of one range check of every game in ``rows``."""
    return f"""
SELECT '{source}/' || game_id AS source, {seq} AS seq, 'range_{side}' AS "check", '{column}' AS "column",
       {n_bad} AS n_bad, {n_total} AS n_total, '{bound}' AS bound,
       'RANGE: {column} has ' || {n_bad} || ' values {side} {bound}' AS message FROM {rows}"""


def _short(seq: int, least: int, n_total: int, source: str, rows: str) -> str:
    return f"""
SELECT '{source}/' || game_id AS source, {seq} AS seq, 'min_rows' AS "check", NULL AS "column",
       {least - n_total} AS n_bad, {n_total} AS n_total, '{least}' AS bound,
       'ROW COUNT: {n_total} rows (expected ≥{least})' AS message FROM {rows}"""


BOXSCORE_ISSUES = " UNION ALL ".join([
    _short(4, 10, 3, "boxscore", "g WHERE st <> 'P'"),
    _range(6, "offensiveRating", "1", "above", 300, 3, "boxscore", "g WHERE st <> 'P' AND k % 350 >= 300"),
])
PLAYED = "g WHERE NOT (st = 'O' AND pr = '5-LOW')"
PBP_ISSUES = " UNION ALL ".join([
    _short(5, 100, 2, "pbp", PLAYED),
    _range(9, "clock_seconds", "1", "above", 720, 2, "pbp", f"{PLAYED} AND (k % 15) * 60 + k % 60 + 0.5 > 720"),
    _range(11, "shotDistance", "1", "above", 94, 2, "pbp", f"{PLAYED} AND k % 100 > 94"),
])
SHOT_ISSUES = " UNION ALL ".join([
    _range(8, "LOC_X", "1", "below", -250, 2, "shots", "g WHERE k % 600 - 300 < -250"),
    _range(9, "LOC_X", "1", "above", 250, 2, "shots", "g WHERE k % 600 - 300 > 250"),
    _range(10, "LOC_Y", "1", "below", -50, 2, "shots", "g WHERE k % 1000 - 60 < -50"),
    _range(11, "LOC_Y", "1", "above", 900, 2, "shots", "g WHERE k % 1000 - 60 > 900"),
    _range(13, "SHOT_DISTANCE", "1", "above", 94, 2, "shots", "g WHERE k % 100 > 94"),
])


@query("contract_boxscore", f"WITH {SILVER_SQL}, r AS ({BOXSCORE_ISSUES}) SELECT {ISSUE_TYPES} FROM r")
def contract_boxscore(spark, sf_dir):
    return contracts.issues(game_results(spark, sf_dir, "boxscores"))


@query("contract_pbp", f"WITH {SILVER_SQL}, r AS ({PBP_ISSUES}) SELECT {ISSUE_TYPES} FROM r")
def contract_pbp(spark, sf_dir):
    return contracts.issues(game_results(spark, sf_dir, "pbp"))


@query("contract_shots", f"WITH {SILVER_SQL}, r AS ({SHOT_ISSUES}) SELECT {ISSUE_TYPES} FROM r")
def contract_shots(spark, sf_dir):
    return contracts.issues(game_results(spark, sf_dir, "shot_chart"))


def _passed(seq: int, column: str, source: str) -> str:
    return f"""
SELECT '{source}' AS source, {seq} AS seq, 'not_null' AS "check", '{column}' AS "column", 0 AS n_bad, n AS n_total,
       NULL AS bound, 'NULL: {column} has 0/' || n || ' nulls' AS message FROM n"""


PLAYERS_CHECKS = " UNION ALL ".join([
    """SELECT 'players' AS source, 0 AS seq, 'pk_unique' AS "check", 'id' AS "column", 0 AS n_bad, n AS n_total,
       NULL AS bound, 'DUPLICATE PK: 0 rows on [''id'']' AS message FROM n""",
    *[_passed(i + 1, c, "players") for i, c in enumerate(["id", "full_name", "first_name", "last_name"])],
    """SELECT 'players', 5, 'min_rows', NULL, greatest(0, 4000 - n), n, '4000',
       'ROW COUNT: ' || n || ' rows (expected ≥4000)' FROM n""",
])


@query("contract_players", f"""
WITH n AS (SELECT count(*) AS n FROM customer), r AS ({PLAYERS_CHECKS}) SELECT {ISSUE_TYPES} FROM r
""")
def contract_players(spark, sf_dir):
    players = silver.players_table(raw.player_items(spark, sf_dir))
    return contracts.all_checks(contracts.check_contract(players, CONTRACTS["players"], "players"))


def _team_range(seq: int, column: str, side: str, bound: int, n_bad: str = "0") -> str:
    return f"""
SELECT 'teams' AS source, {seq} AS seq, 'range_{side}' AS "check", '{column}' AS "column", {n_bad} AS n_bad, n AS n_total,
       '{bound}' AS bound, 'RANGE: {column} has ' || {n_bad} || ' values {side} {bound}' AS message FROM n"""


TEAM_CHECKS = " UNION ALL ".join([
    """SELECT 'teams' AS source, 0 AS seq, 'pk_unique' AS "check", 'GAME_ID,TEAM_ID' AS "column", 0 AS n_bad,
       n AS n_total, NULL AS bound, 'DUPLICATE PK: 0 rows on [''GAME_ID'', ''TEAM_ID'']' AS message FROM n""",
    *[_passed(i + 1, c, "teams") for i, c in enumerate(["GAME_ID", "TEAM_ID", "GAME_DATE", "PTS"])],
    """SELECT 'teams', 5, 'min_rows', NULL, greatest(0, 50000 - n), n, '50000',
       'ROW COUNT: ' || n || ' rows (expected ≥50000)' FROM n""",
    _team_range(6, "PTS", "below", 0), _team_range(7, "PTS", "above", 200, "high"),
    *[
        _team_range(8 + 2 * i + j, column, side, j)
        for i, column in enumerate(["FG_PCT", "FG3_PCT", "FT_PCT"])
        for j, side in enumerate(["below", "above"])
    ],
])


@query("contract_teams", f"""
WITH {raw.TEAM_GAMES_SQL},
n AS (SELECT count(*) AS n, count(*) FILTER (WHERE pts > 200) AS high FROM team_games),
r AS ({TEAM_CHECKS}) SELECT {ISSUE_TYPES} FROM r
""")
def contract_teams(spark, sf_dir):
    teams, _ = silver.team_games_table(raw.team_documents(spark, sf_dir))
    return contracts.all_checks(contracts.check_contract(teams, CONTRACTS["teams"], "teams"))


@query("passed_failed", f"""
WITH {SILVER_SQL}, r AS ({SHOT_ISSUES}), bad AS (SELECT count(DISTINCT source) AS n FROM r),
a AS (SELECT count(*) AS n FROM g)
SELECT a.n AS checked, a.n - bad.n AS passed, bad.n AS failed FROM a, bad
""")
def passed_failed(spark, sf_dir):
    return contracts.passed_failed(game_results(spark, sf_dir, "shot_chart"))


@query("validation_report", f"""
WITH {SILVER_SQL}, r AS (
  SELECT source, seq, message FROM ({SHOT_ISSUES})
  UNION ALL SELECT source, seq, message FROM ({BOXSCORE_ISSUES})),
bad AS (SELECT count(DISTINCT source) AS n FROM r),
a AS (SELECT count(*) + count(*) FILTER (WHERE st <> 'P') AS n FROM g)
SELECT source, seq::INT AS seq, message AS line FROM r
UNION ALL SELECT '*', -1, 'checked ' || a.n || ', passed ' || (a.n - bad.n) || ', failed ' || bad.n FROM a, bad
""")
def validation_report(spark, sf_dir):
    return contracts.validation_report(
        game_results(spark, sf_dir, "shot_chart"), game_results(spark, sf_dir, "boxscores")
    )


@query("contract_of_lines", f"""
WITH c AS (SELECT count(*) AS n, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS d,
                  count(*) FILTER (WHERE l_quantity > 45 AND l_linenumber <> 7) AS h FROM lineitem),
r AS (
  SELECT 'lineitem' AS source, 0 AS seq, 'pk_unique' AS "check", 'l_orderkey,l_linenumber' AS "column", d AS n_bad,
         n AS n_total, NULL AS bound, 'DUPLICATE PK: ' || d || ' rows on [''l_orderkey'', ''l_linenumber'']' AS message FROM c
  UNION ALL SELECT 'lineitem', 2, 'range_above', 'quantity', h, n, '45', 'RANGE: quantity has ' || h || ' values above 45' FROM c)
SELECT {ISSUE_TYPES} FROM r
""")
def contract_of_lines(spark, sf_dir):
    contract = Contract(
        primary_key=("l_orderkey", "l_linenumber"), not_null=("l_returnflag",),
        ranges=(("quantity", None, 45), ("absent", 0, 1)),
    )
    return contracts.issues(contracts.check_contract(_lines(spark, sf_dir), contract, "lineitem"))
