"""Raw documents derived from the given tables.

Every order is one game: its documents are built from its own row, so the
derivation needs no grouping and grows with the table. The SQL fragments state
the same games for the comparison.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.operators.worklist import MANIFEST_PART_SIZE, build_manifests
from courtlake.sources.documents import (
    manifest_entries, parse_documents, parse_json_array, split_corrupt,
)
from harness.registry import table

# Games of the comparison: key k, customer c, status st, priority pr.
GAMES_SQL = """
g AS (
  SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS game_id,
         date_trunc('month', o_orderdate)::DATE AS game_date,
         o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
         (o_custkey % 40 + 1) AS home_id, (o_custkey % 40 + 41) AS away_id
  FROM orders
),
season_g AS (
  SELECT *, (CASE WHEN month(game_date) >= 10 THEN year(game_date)
                  ELSE year(game_date) - 1 END)::INT AS season
  FROM g
)"""

# Silver box-score rows of the comparison (after keep-first and quarantine).
PLAYERS_SQL = GAMES_SQL + """,
players_of AS (
  SELECT *, 'HOME' AS side, home_id AS team_id, 'H' || (c % 30) AS tricode,
         c * 4 + 1 AS person_id, 'C' || c AS first_name,
         CASE st WHEN 'O' THEN '' WHEN 'F' THEN NULL END AS family_name, 'G' AS position,
         (k % 48) || ':' || lpad((k % 60)::VARCHAR, 2, '0') AS minutes,
         (k % 350) + 0.5 AS off_rating, 0 AS row_pos
  FROM season_g WHERE st <> 'P'
  UNION ALL
  SELECT *, 'HOME', home_id, 'H' || (c % 30), c * 4 + 2, 'C' || c, 'Two', 'C',
         'PT' || (k % 48) || 'M' || (k % 60) || '.50S', (k % 300) + 0.25, 1
  FROM season_g WHERE st <> 'P'
  UNION ALL
  SELECT *, 'AWAY', away_id, '', c * 4 + 3, 'A' || c, 'Three', '', '', NULL, 1::BIGINT << 40
  FROM season_g WHERE st <> 'P'
)"""


#: Rows of a table that one task makes documents of.
TASK_ROWS = 50_000


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table in as many parts as its rows ask for, and at least one for each core.

    A row of a few bytes becomes a document of many, so the splits of the file say little about the work.
    """
    parts = max(spark.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))
    return df.repartition(parts) if df.rdd.getNumPartitions() < parts else df


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    return orders.select(
        F.lpad(F.col("o_orderkey").cast("string"), 10, "0").alias("game_id"),
        F.trunc("o_orderdate", "MM").alias("game_date"),
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"),
        F.col("o_orderstatus").alias("st"), F.col("o_orderpriority").alias("pr"),
        (F.col("o_custkey") % 40 + 1).alias("home_id"),
        (F.col("o_custkey") % 40 + 41).alias("away_id"),
    )


def filled(template: str, *values: Column) -> Column:
    """The template with a value in place of each ``%s`` or ``%d``, null as ``null``.

    As ``format_string``, which parses the template anew for each row.
    """
    first, *rest = re.split("%[sd]", template)
    return F.concat(F.lit(first), *[
        part for value, after in zip(values, rest, strict=True)
        for part in (F.coalesce(value.cast("string"), F.lit("null")), F.lit(after))])


def two_digits(column) -> F.Column:
    return F.lpad(column.cast("string"), 2, "0")


def boxscore_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, game_date, doc): box scores with two sides.

    A game of status P has no payload. The home side lists its first player a
    second time with other numbers; the away side lacks its code and ends with a
    player whose id is a fraction.
    """
    g = spread(spark, games(spark, sf_dir))
    k, c = F.col("k"), F.col("c")
    family = F.when(F.col("st") == "O", "").when(F.col("st") == "F", ',"familyName":null')
    first = filled(
        '{"personId":%d,"firstName":"C%d"%s,"position":"G","comment":"","statistics":{"minutes":'
        '"%d:%s","offensiveRating":%d.5,"defensiveRating":"n/a","usagePercentage":0.25,"pace":%d}}',
        c * 4 + 1, c, family, k % 48, two_digits(k % 60), k % 350, k % 100,
    )
    second = filled(
        '{"personId":%d,"firstName":"C%d","familyName":"Two","position":"C","statistics":'
        '{"minutes":"PT%dM%d.50S","offensiveRating":%d.25,"PIE":0.125}}',
        c * 4 + 2, c, k % 48, k % 60, k % 300,
    )
    again = filled(
        '{"personId":%d,"firstName":"again","familyName":"x","position":"F","statistics":'
        '{"minutes":"1:00","offensiveRating":1}}', c * 4 + 1,
    )
    third = filled(
        '{"personId":%d,"firstName":"A%d","familyName":"Three","statistics":{"minutes":""}}',
        c * 4 + 3, c,
    )
    fraction = filled('{"personId":%d.5,"firstName":"half","statistics":{}}', c)
    doc = F.when(F.col("st") == "P", F.lit('{"meta":{"version":1}}')).otherwise(filled(
        '{"boxScoreAdvanced":{"homeTeam":{"teamId":%d,"teamTricode":"H%d","players":[%s,%s,%s]},'
        '"awayTeam":{"teamId":%d,"players":[%s,%s]}}}',
        F.col("home_id"), c % 30, first, second, again, F.col("away_id"), third, fraction,
    ))
    return g.select("game_id", "game_date", doc.alias("doc"))


def action_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, game_date, doc): play-by-play with a start, a shot, and the shot again.

    A game of status O with priority 5-LOW has an empty list.
    """
    g = spread(spark, games(spark, sf_dir))
    k, c = F.col("k"), F.col("c")
    start = F.lit(
        '{"actionNumber":1,"clock":"PT12M00.00S","period":1,"teamId":0,"personId":0,'
        '"actionType":"period","subType":"start","description":"","shotDistance":0,'
        '"scoreHome":"0","scoreAway":"0","isFieldGoal":0}'
    )
    shot = filled(
        '{"actionNumber":2,"clock":"PT%dM%d.50S","period":%d,"teamId":%d,"personId":%d,'
        '"actionType":"2pt","subType":"Jump Shot","description":"shot %d","shotDistance":%d,'
        '"scoreHome":"2","scoreAway":"0","isFieldGoal":1,"side":"left"}',
        k % 15, k % 60, k % 4 + 1, F.col("home_id"), c * 4 + 1, k, k % 100,
    )
    again = filled(
        '{"actionNumber":2,"clock":"PT0M0.0S","period":1,"description":"again %d"}', k,
    )
    empty = (F.col("st") == "O") & (F.col("pr") == "5-LOW")
    doc = F.when(empty, F.lit('{"game":{"actions":[]}}')).otherwise(
        filled('{"game":{"gameId":"x","actions":[%s,%s,%s]}}', start, shot, again)
    )
    return g.select("game_id", "game_date", doc.alias("doc"))


def shot_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(game_id, game_date, doc): shot charts with two shots and a second result set.

    The first shot belongs to the home side's first player, the second to a
    player of the next customer, who may first appear on a later date or never.
    """
    g = spread(spark, games(spark, sf_dir))
    k, c = F.col("k"), F.col("c")
    headers = (
        '["GRID_TYPE","GAME_ID","GAME_EVENT_ID","PLAYER_ID","TEAM_ID","PERIOD",'
        '"SHOT_ZONE_BASIC","SHOT_DISTANCE","LOC_X","LOC_Y","SHOT_ATTEMPTED_FLAG",'
        '"SHOT_MADE_FLAG","GAME_DATE","SHOT_COLOR"]'
    )
    day = F.date_format("game_date", "yyyyMMdd")
    first = filled(
        '["Shot","payload",10,%d,%d,%d,"Mid-Range",%d,%d,%d,1,%d,"%s","red"]',
        c * 4 + 1, F.col("home_id"), k % 4 + 1, k % 100, k % 600 - 300, k % 1000 - 60, k % 2, day,
    )
    second = filled(
        '["Shot","payload",11,%d,%d,%d,"Paint",%d,%d.5,%d,1,0,"bad date",null]',
        (c + 1) * 4 + 1, F.col("away_id"), F.lit(1), F.lit(3), k % 10, k % 10,
    )
    doc = filled(
        '{"resource":"x","resultSets":[{"name":"Detail","headers":%s,"rowSet":[%s,%s]},'
        '{"name":"GameHeader","headers":["SEQ","GAME_ID"],"rowSet":[[1,"%s"]]}]}',
        F.lit(headers), first, second, F.col("game_id"),
    )
    return g.select("game_id", "game_date", doc.alias("doc"))


DOCUMENTS = {
    "boxscores": (boxscore_texts, schemas.BOXSCORE_DOC),
    "pbp": (action_texts, schemas.ACTIONS_DOC),
    "shot_chart": (shot_texts, schemas.RESULT_SET_DOC),
}


def documents(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Decoded documents of a dataset, keyed by ``file_key``."""
    texts, schema = DOCUMENTS[dataset]
    named = texts(spark, sf_dir).select(F.col("game_id").alias("file_key"), "doc")
    return split_corrupt(parse_documents(named, "doc", schema))[0]


def all_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {dataset: documents(spark, sf_dir, dataset) for dataset in DOCUMENTS}


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per date that has games."""
    g = games(spark, sf_dir)
    ids = g.select("game_date", F.col("k").alias("pos"), "game_id")
    return build_manifests(g.select("game_date").distinct(), ids, MANIFEST_PART_SIZE)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_entries(manifests(spark, sf_dir))


def player_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player objects, two per customer and one a repeat, out of JSON arrays."""
    customers = table(spark, sf_dir, "customer")
    text = filled(
        '[{"id":%d,"full_name":"  %s ","first_name":" F%d","last_name":"L%d\\t","is_active":%s},'
        '{"id":%d,"full_name":"repeat","first_name":"r","last_name":"r","is_active":true}]',
        F.col("c_custkey") * 4 + 1, F.col("c_name"), F.col("c_custkey"), F.col("c_nationkey"),
        F.when(F.col("c_acctbal") > 0, "true").otherwise("false"), F.col("c_custkey") * 4 + 1,
    )
    return parse_json_array(customers.select(text.alias("doc")), "doc", schemas.PLAYERS_DOC)


TEAM_HEADERS = (
    '["SEASON_ID","TEAM_ID","TEAM_ABBREVIATION","TEAM_NAME","GAME_ID","GAME_DATE","MATCHUP","WL",'
    '"MIN","PTS","FGM","FG_PCT","PLUS_MINUS"]'
)


def team_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team-history files, one per game with a row for either side.

    Status P: with priority 5-LOW the file is malformed, with 2-HIGH a score is
    a fraction, with 1-URGENT there is no result set. The others are good.
    """
    g = spread(spark, games(spark, sf_dir))
    k = F.col("k")
    day = F.date_format("game_date", "yyyy-MM-dd")

    share = F.when(k >= 0, F.concat(F.lit("0."), F.lpad((k % 1000).cast("string"), 3, "0"))).otherwise(
        F.format_string("0.%03d", k % 1000))

    def row(team, label: str, points, wl: str):
        return filled(
            '["2%d",%d,"T%d","%s %d","%s","%s","A vs. B","%s",%d,%s,%d,%s,%d]',
            F.year("game_date"), team, team, F.lit(label), team, F.col("game_id"), day,
            F.lit(wl), F.lit(240), points, k % 50, share, k % 21 - 10,
        )

    is_p = F.col("st") == "P"
    points = F.when(is_p & (F.col("pr") == "2-HIGH"), F.lit("99.5")).otherwise(
        (k % 230).cast("string")
    )
    good = filled(
        '{"resultSets":[{"name":"Games","headers":%s,"rowSet":[%s,%s]}]}',
        F.lit(TEAM_HEADERS), row(F.col("home_id"), "Home", points, "W"),
        row(F.col("away_id"), "Away", F.lit("88"), "L"),
    )
    doc = (
        F.when(is_p & (F.col("pr") == "5-LOW"), F.lit('{"resultSets":[{"name":'))
        .when(is_p & (F.col("pr") == "1-URGENT"), F.lit('{"resultSets":[]}'))
        .otherwise(good)
    )
    named = g.select(F.col("game_id").alias("file_key"), doc.alias("doc"))
    return parse_documents(named, "doc", schemas.RESULT_SET_DOC)


# Team-history rows of the comparison.
TEAM_GAMES_SQL = GAMES_SQL + """,
team_games AS (
  SELECT *, home_id AS team_id, 'Home ' || home_id AS team_name, 'W' AS wl, k % 230 AS pts
  FROM season_g WHERE NOT (st = 'P' AND pr IN ('5-LOW', '2-HIGH', '1-URGENT'))
  UNION ALL
  SELECT *, away_id, 'Away ' || away_id, 'L', 88
  FROM season_g WHERE NOT (st = 'P' AND pr IN ('5-LOW', '2-HIGH', '1-URGENT'))
)"""
