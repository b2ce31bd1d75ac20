"""Scans and decoding of raw documents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.functions.text import get_or_default
from courtlake.operators import flatten, worklist
from courtlake.operators.dedupe import keep_first
from courtlake.plans import silver
from courtlake.session import shared_dir
from courtlake.sources import documents, resultset
from harness import raw
from harness.registry import query, table

# Small, so that most dates have several parts.
PART = 3

DAYS_SQL = """
days AS (
  SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS game_date
  FROM orders
)"""


def day_manifests(spark, sf_dir):
    """A manifest per calendar day, with an empty list on days without orders."""
    from courtlake.functions.dates import date_sequence

    orders = table(spark, sf_dir, "orders")
    span = orders.agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    in_order = Window.partitionBy("o_orderdate").orderBy("o_orderkey")
    ids = orders.select(
        F.col("o_orderdate").alias("game_date"), (F.row_number().over(in_order) - 1).alias("pos"),
        F.col("o_orderkey").cast("string").alias("game_id"),
    )
    return worklist.build_manifests(date_sequence(span, "first", "last"), ids, PART)


@query("write_manifest", f"""
WITH {DAYS_SQL},
placed AS (
  SELECT o_orderdate::DATE AS game_date, o_orderkey,
         row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS pos FROM orders),
parts AS (
  SELECT game_date, pos // {PART} * {PART} AS first_pos, count(*) AS n_ids,
         string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids
  FROM placed GROUP BY ALL)
SELECT game_date, coalesce(first_pos, 0) AS first_pos, coalesce(n_ids, 0)::INT AS n_ids, coalesce(ids, '') AS ids
FROM days LEFT JOIN parts USING (game_date)
""")
def write_manifest(spark, sf_dir):
    path = shared_dir(spark, "manifests")
    worklist.write_manifests(day_manifests(spark, sf_dir), path)
    return documents.scan_manifests(spark, path).select(
        "game_date", "first_pos", F.size("game_ids").alias("n_ids"),
        F.array_join("game_ids", ",").alias("ids"),
    )


POSITION_SQL = "row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1"


@query("scan_manifest", f"""
SELECT o_orderdate::DATE AS game_date, {POSITION_SQL} AS manifest_pos, o_orderkey::VARCHAR AS game_id
FROM orders
""")
def scan_manifest(spark, sf_dir):
    path = shared_dir(spark, "manifests")
    worklist.write_manifests(day_manifests(spark, sf_dir), path)
    return documents.manifest_entries(documents.scan_manifests(spark, path))


@query("manifest_join", f"""
WITH e AS (SELECT o_orderkey, o_orderdate::DATE AS game_date, {POSITION_SQL} AS manifest_pos FROM orders)
SELECT game_date, manifest_pos, o_orderkey::VARCHAR AS game_id, l_partkey, l_quantity
FROM e JOIN lineitem ON l_orderkey = o_orderkey
""")
def manifest_join(spark, sf_dir):
    docs = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("file_key"), "l_partkey", "l_quantity"
    )
    entries = documents.manifest_entries(day_manifests(spark, sf_dir))
    return documents.listed_documents(docs, entries)


@query("scan_listed_files", f"""
WITH e AS (SELECT o_orderkey, o_orderstatus, o_orderdate::DATE AS game_date, {POSITION_SQL} AS manifest_pos
           FROM orders)
SELECT o_orderkey::VARCHAR AS game_id, game_date, manifest_pos FROM e WHERE o_orderstatus <> 'P'
""")
def scan_listed_files(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").cast("string").alias("file_key")
    )
    entries = documents.manifest_entries(day_manifests(spark, sf_dir))
    return documents.listed_documents(docs, entries)


@query("skip_no_game_days", """
SELECT o_orderdate::DATE AS game_date, count(*) AS n_games FROM orders GROUP BY ALL
""")
def skip_no_game_days(spark, sf_dir):
    kept = documents.skip_no_game_days(day_manifests(spark, sf_dir))
    return kept.groupBy("game_date").agg(F.sum(F.size("game_ids")).alias("n_games"))


@query("skip_empty_docs", f"""
WITH {raw.GAMES_SQL} SELECT game_id FROM g WHERE NOT (st = 'O' AND pr = '5-LOW')
""")
def skip_empty_docs(spark, sf_dir):
    docs = raw.documents(spark, sf_dir, "pbp")
    return documents.keep_nonempty(docs, "game.actions").select(F.col("file_key").alias("game_id"))


@query("scan_nested_doc", f"WITH {raw.GAMES_SQL} SELECT game_id, home_id FROM g WHERE st <> 'P'")
def scan_nested_doc(spark, sf_dir):
    docs = raw.documents(spark, sf_dir, "boxscores")
    return docs.where(F.col("boxScoreAdvanced").isNotNull()).select(
        F.col("file_key").alias("game_id"),
        F.col("boxScoreAdvanced.homeTeam")["teamId"].cast("bigint").alias("home_id"),
    )


@query("scan_actions_doc", f"""
WITH {raw.GAMES_SQL}, full_g AS (SELECT * FROM g WHERE NOT (st = 'O' AND pr = '5-LOW'))
SELECT game_id, 0 AS pos, '1' AS action_number, 'PT12M00.00S' AS clock FROM full_g
UNION ALL
SELECT game_id, 1, '2', 'PT' || (k % 15) || 'M' || (k % 60) || '.50S' FROM full_g
UNION ALL
SELECT game_id, 2, '2', 'PT0M0.0S' FROM full_g
""")
def scan_actions_doc(spark, sf_dir):
    docs = raw.documents(spark, sf_dir, "pbp")
    return docs.select("file_key", F.posexplode("game.actions").alias("pos", "action")).select(
        F.col("file_key").alias("game_id"), "pos",
        F.col("action")["actionNumber"].alias("action_number"), F.col("action")["clock"].alias("clock"),
    )


def _line_sets(spark, sf_dir):
    """A result-set document per line item, three amounts in the first set."""
    lines = raw.spread(spark, table(spark, sf_dir, "lineitem"))
    key, line = F.col("l_orderkey"), F.col("l_linenumber")

    def row(kind: str, amount: str):
        return F.format_string(f'[%d,%d,"{kind}",%s]', key, line, F.col(amount).cast("string"))

    doc = F.format_string(
        '{"resultSets":[{"name":"Lines","headers":["ORDER","LINE","KIND","AMOUNT"],'
        '"rowSet":[%s,%s,%s]},{"name":"Header","headers":["PART","GAME_ID"],"rowSet":[[%d,"%d-%d"]]}]}',
        row("price", "l_extendedprice"), row("discount", "l_discount"), row("tax", "l_tax"),
        F.col("l_partkey"), key, line,
    )
    return documents.parse_documents(
        lines.select("l_partkey", doc.alias("doc")), "doc", schemas.RESULT_SET_DOC
    ).drop(documents.CORRUPT)


@query("decode_resultset", """
SELECT l_orderkey AS game, l_linenumber AS line, 0 AS row_pos, 'price' AS kind, l_extendedprice AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 1, 'discount', l_discount + 0.0::DOUBLE FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 2, 'tax', l_tax FROM lineitem
""")
def decode_resultset(spark, sf_dir):
    rows = resultset.decode_resultset(_line_sets(spark, sf_dir), position=0)
    return resultset.project_row(rows, ["ORDER", "LINE", "KIND", "AMOUNT"]).select(
        F.col("ORDER").cast("bigint").alias("game"), F.col("LINE").cast("int").alias("line"),
        F.col("_row_pos").alias("row_pos"), F.col("KIND").alias("kind"),
        (F.col("AMOUNT").cast("double") + F.lit(0.0)).alias("amount"),
    )


@query("decode_resultset_named", """
SELECT l_partkey, l_orderkey || '-' || l_linenumber AS game_id FROM lineitem
""")
def decode_resultset_named(spark, sf_dir):
    rows = resultset.decode_resultset(_line_sets(spark, sf_dir), name="Header")
    return rows.select("l_partkey", resultset.header_column("GAME_ID", "game_id"))


@query("scan_json_array", """
SELECT c_custkey * 4 + 1 AS id, 0 AS pos, '  ' || c_name || ' ' AS full_name, c_acctbal > 0 AS is_active FROM customer
UNION ALL SELECT c_custkey * 4 + 1, 1, 'repeat', true FROM customer
""")
def scan_json_array(spark, sf_dir):
    return raw.player_items(spark, sf_dir).select(
        F.col("id").cast("bigint").alias("id"), F.col("_row_pos").alias("pos"), "full_name", "is_active"
    )


@query("scan_multi_file_tolerant", """
WITH bad AS (SELECT DISTINCT o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
SELECT o_orderdate::DATE AS file, o_orderkey, o_totalprice FROM orders ANTI JOIN bad USING (o_orderdate)
""")
def scan_multi_file_tolerant(spark, sf_dir):
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    text = F.when(broken, '{"key": 1, "price').otherwise(F.format_string(
        '{"key":%d,"price":%s}', F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    ))
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("file"), text.alias("doc"))
    parsed = documents.parse_documents(lines, "doc", "key bigint, price double")
    good, _ = documents.drop_failed_files(parsed, "file", F.col(documents.CORRUPT).isNotNull())
    return good.select(
        "file", F.col("key").alias("o_orderkey"), F.col("price").alias("o_totalprice")
    )


@query("file_order", """
SELECT o_custkey, min(lpad(o_orderkey::VARCHAR, 10, '0')) AS file FROM orders GROUP BY ALL
""")
def file_order(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(
        F.format_string("%010d", F.col("o_orderkey")).alias("file"), "o_custkey"
    )
    return keep_first(files, ["o_custkey"], ["file"]).select("o_custkey", "file")


@query("flatten_nested", f"""
WITH {raw.GAMES_SQL}, f AS (SELECT * FROM g WHERE st <> 'P')
SELECT game_id, 'HOME' AS side, home_id AS team_id, (c * 4 + 1)::VARCHAR AS person, 0::BIGINT AS row_pos FROM f
UNION ALL SELECT game_id, 'HOME', home_id, (c * 4 + 2)::VARCHAR, 1 FROM f
UNION ALL SELECT game_id, 'HOME', home_id, (c * 4 + 1)::VARCHAR, 2 FROM f
UNION ALL SELECT game_id, 'AWAY', away_id, (c * 4 + 3)::VARCHAR, 1::BIGINT << 40 FROM f
UNION ALL SELECT game_id, 'AWAY', away_id, c || '.5', (1::BIGINT << 40) + 1 FROM f
""")
def flatten_nested(spark, sf_dir):
    rows = flatten.flatten_sides(raw.documents(spark, sf_dir, "boxscores"))
    return rows.select(
        F.col("file_key").alias("game_id"), "side",
        F.col("team")["teamId"].cast("bigint").alias("team_id"),
        F.col("player")["personId"].alias("person"), F.col("_row_pos").alias("row_pos"),
    )


@query("default_if_missing", f"""
WITH {raw.PLAYERS_SQL}
SELECT game_id, person_id::VARCHAR AS person, family_name, tricode FROM players_of
UNION ALL SELECT game_id, (c * 4 + 1)::VARCHAR, 'x', 'H' || (c % 30) FROM g WHERE st <> 'P'
UNION ALL SELECT game_id, c || '.5', '', '' FROM g WHERE st <> 'P'
""")
def default_if_missing(spark, sf_dir):
    rows = flatten.flatten_sides(raw.documents(spark, sf_dir, "boxscores"))
    return rows.select(
        F.col("file_key").alias("game_id"), F.col("player")["personId"].alias("person"),
        get_or_default("player", "familyName").alias("family_name"),
        get_or_default("team", "teamTricode").alias("tricode"),
    )


@query("spread_map", """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       CASE WHEN event_type = 'click' THEN user_id::VARCHAR END AS click,
       CASE WHEN event_type = 'error' THEN user_id::VARCHAR END AS error,
       CASE WHEN event_type = 'purchase' THEN user_id::VARCHAR END AS purchase,
       CASE WHEN event_type = 'signup' THEN user_id::VARCHAR END AS signup,
       CASE WHEN event_type = 'view' THEN user_id::VARCHAR END AS "view"
FROM events
""")
def spread_map(spark, sf_dir):
    named = F.map_concat(
        F.from_json("props", schemas.STATISTICS),
        F.create_map("event_type", F.col("user_id").cast("string")),
    )
    events = table(spark, sf_dir, "events").select("event_id", named.alias("statistics"))
    return flatten.spread_map(events, "statistics")


@query("open_columns", f"""
WITH {raw.GAMES_SQL}, f AS (SELECT * FROM g WHERE NOT (st = 'O' AND pr = '5-LOW'))
SELECT game_id, 0 AS pos, 'period' AS action_type, NULL::VARCHAR AS side, 0 AS n_extras FROM f
UNION ALL SELECT game_id, 1, '2pt', 'left', 1 FROM f
UNION ALL SELECT game_id, 2, NULL, NULL, 0 FROM f
""")
def open_columns(spark, sf_dir):
    docs = raw.documents(spark, sf_dir, "pbp")
    actions = docs.select(
        F.col("file_key").alias("game_id"), F.posexplode("game.actions").alias("pos", "action")
    )
    rows = flatten.open_columns(actions, "action", schemas.ACTION_FIELDS)
    return rows.select(
        "game_id", "pos", F.col("actionType").alias("action_type"),
        F.col("extras")["side"].alias("side"), F.size("extras").alias("n_extras"),
    )


# ---- silver datasets -----------------------------------------------------

SILVER_SQL = raw.PLAYERS_SQL + """,
actions_of AS (
  SELECT *, 1 AS action_number, 'PT12M00.00S' AS clock, 1 AS period, 0 AS team, 0 AS player,
         'period' AS action_type, '' AS description, 0.0::DOUBLE AS shot_distance, 0 AS score_home,
         false AS is_field_goal, 720.0::DOUBLE AS clock_seconds, 0 AS row_pos
  FROM season_g WHERE NOT (st = 'O' AND pr = '5-LOW')
  UNION ALL
  SELECT *, 2, 'PT' || (k % 15) || 'M' || (k % 60) || '.50S', k % 4 + 1, home_id, c * 4 + 1,
         '2pt', 'shot ' || k, (k % 100)::DOUBLE, 2, true,
         ((k % 15) * 60 + k % 60)::DOUBLE + 0.5::DOUBLE, 1
  FROM season_g WHERE NOT (st = 'O' AND pr = '5-LOW')
),
shots_of AS (
  SELECT *, 10 AS event, c * 4 + 1 AS player, home_id AS team, k % 4 + 1 AS period,
         (k % 100)::DOUBLE AS distance, (k % 600 - 300)::DOUBLE AS x, (k % 1000 - 60)::DOUBLE AS y,
         k % 2 = 1 AS made, game_date AS day, 'Mid-Range' AS zone
  FROM season_g
  UNION ALL
  SELECT *, 11, (c + 1) * 4 + 1, away_id, 1, 3, (k % 10) + 0.5::DOUBLE, (k % 10)::DOUBLE, false,
         NULL, 'Paint'
  FROM season_g
)"""


def _silver(spark, sf_dir, dataset):
    docs = {dataset: raw.documents(spark, sf_dir, dataset)}
    return silver.build_silver(raw.entries(spark, sf_dir), docs)


@query("boxscore_rows", f"""
WITH {SILVER_SQL}
SELECT season, game_date, game_id, person_id, team_id, side, tricode, first_name, family_name,
       position, minutes, off_rating::DOUBLE AS off_rating, row_pos FROM players_of
""")
def boxscore_rows(spark, sf_dir):
    return _silver(spark, sf_dir, "boxscores").rows["boxscores"].select(
        "season", "game_date", F.col("GAME_ID").alias("game_id"),
        F.col("PERSON_ID").alias("person_id"), F.col("TEAM_ID").alias("team_id"),
        F.col("TEAM_TYPE").alias("side"), F.col("TEAM_TRICODE").alias("tricode"),
        F.col("FIRST_NAME").alias("first_name"), F.col("FAMILY_NAME").alias("family_name"),
        F.col("POSITION").alias("position"), "minutes",
        F.col("offensiveRating").alias("off_rating"), F.col("_row_pos").alias("row_pos"),
    )


@query("play_rows", f"""
WITH {SILVER_SQL}
SELECT season, game_date, game_id, action_number::BIGINT AS action_number, clock, period::BIGINT AS period,
       team::BIGINT AS team_id, player::BIGINT AS player_id, action_type, description, shot_distance,
       score_home::BIGINT AS score_home, is_field_goal, clock_seconds, row_pos FROM actions_of
""")
def play_rows(spark, sf_dir):
    return _silver(spark, sf_dir, "pbp").rows["pbp"].select(
        "season", "game_date", F.col("GAME_ID").alias("game_id"),
        F.col("actionNumber").alias("action_number"), "clock", "period",
        F.col("teamId").alias("team_id"), F.col("personId").alias("player_id"),
        F.col("actionType").alias("action_type"), "description",
        F.col("shotDistance").alias("shot_distance"), F.col("scoreHome").alias("score_home"),
        F.col("isFieldGoal").alias("is_field_goal"), "clock_seconds",
        F.col("_row_pos").alias("row_pos"),
    )


@query("shot_rows", f"""
WITH {SILVER_SQL}
SELECT season, game_date, game_id, event::BIGINT AS event, player AS player_id, team AS team_id,
       period::BIGINT AS period, distance, x, y, made, day, zone FROM shots_of
""")
def shot_rows(spark, sf_dir):
    return _silver(spark, sf_dir, "shot_chart").rows["shot_chart"].select(
        "season", "game_date", F.col("GAME_ID").alias("game_id"),
        F.col("GAME_EVENT_ID").alias("event"), F.col("PLAYER_ID").alias("player_id"),
        F.col("TEAM_ID").alias("team_id"), F.col("PERIOD").alias("period"),
        F.col("SHOT_DISTANCE").alias("distance"), F.col("LOC_X").alias("x"),
        F.col("LOC_Y").alias("y"), F.col("SHOT_MADE_FLAG").alias("made"),
        F.col(schemas.SHOT_DATE).alias("day"), F.col("SHOT_ZONE_BASIC").alias("zone"),
    )


@query("quarantined_ids", f"""
WITH {SILVER_SQL} SELECT game_id, game_date, (1::BIGINT << 40) + 1 AS row_pos FROM g WHERE st <> 'P'
""")
def quarantined_ids(spark, sf_dir):
    return _silver(spark, sf_dir, "boxscores").quarantine["boxscores"].select(
        F.col("GAME_ID").alias("game_id"), "game_date", F.col("_row_pos").alias("row_pos")
    )
