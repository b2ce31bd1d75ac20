"""Whole jobs over documents derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.functions.dates import season_of_date
from courtlake import schemas
from courtlake.operators import ledger, report, store, worklist
from courtlake.plans import gold, jobs, silver
from courtlake.session import shared_dir
from courtlake.sources import documents, tables
from courtlake.streaming.incremental import incremental_run
from courtlake.schemas import DATASETS
from harness import raw
from harness.document_queries import SILVER_SQL
from harness.registry import query, table
from harness.table_queries import FK_SQL, line_references, lines

BUCKETS = 4


def documents_of(spark, sf_dir):
    return lambda _session, _entries: raw.all_documents(spark, sf_dir)


def new_store(spark):
    """(silver root, empty gold store) in a new shared folder."""
    root = shared_dir(spark, "job")
    return f"{root}/silver", store.create_tables(spark, f"{root}/gold", fact_buckets=BUCKETS)


# ---- silver --------------------------------------------------------------

def silver_union(rows):
    """The three datasets in common columns."""
    key = {"boxscores": "PERSON_ID", "pbp": "actionNumber", "shot_chart": "GAME_EVENT_ID"}
    amount = {"boxscores": "offensiveRating", "pbp": "clock_seconds", "shot_chart": "LOC_X"}
    team = {"boxscores": "TEAM_ID", "pbp": "teamId", "shot_chart": "TEAM_ID"}
    frames = [
        rows[d].select(
            F.lit(d).alias("dataset"), "season", "game_date", F.col("GAME_ID").alias("game_id"),
            F.col(key[d]).alias("item"), F.col(team[d]).alias("team_id"),
            F.col(amount[d]).alias("amount"),
        )
        for d in DATASETS
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


SILVER_UNION_SQL = """
SELECT 'boxscores' AS dataset, season, game_date, game_id, person_id AS item, team_id, off_rating::DOUBLE AS amount
FROM players_of
UNION ALL SELECT 'pbp', season, game_date, game_id, action_number, team, clock_seconds FROM actions_of
UNION ALL SELECT 'shot_chart', season, game_date, game_id, event, team, x FROM shots_of"""


@query("build_silver", f"WITH {SILVER_SQL} {SILVER_UNION_SQL}")
def build_silver(spark, sf_dir):
    root = shared_dir(spark, "silver")
    built = silver.build_silver(raw.entries(spark, sf_dir), raw.all_documents(spark, sf_dir))
    silver.write_silver(built, root)
    return silver_union({d: tables.scan_silver(spark, root, d) for d in DATASETS})


@query("build_dims_silver", f"""
WITH {raw.TEAM_GAMES_SQL}
SELECT 'teams' AS "table", game_id AS id, team_id AS item, team_name AS name, game_date AS day, pts AS n,
       k % 21 - 10 + 0.0::DOUBLE AS amount, NULL::BOOLEAN AS is_active, 'T' || team_id AS a,
       '2' || year(game_date) AS b, 'A vs. B' AS matchup, wl, '240' AS minutes, k % 50 AS fgm,
       ('0.' || lpad((k % 1000)::VARCHAR, 3, '0'))::DOUBLE AS fg_pct, 15 AS n_absent FROM team_games
UNION ALL
SELECT 'players', NULL, c_custkey * 4 + 1, c_name, NULL, NULL, NULL, c_acctbal > 0, 'F' || c_custkey,
       'L' || c_nationkey, NULL, NULL, NULL, NULL, NULL, NULL FROM customer
""")
def build_dims_silver(spark, sf_dir):
    """All columns; those that no document holds are counted."""
    root = shared_dir(spark, "silver")
    silver.build_dims_silver(
        spark, raw.player_items(spark, sf_dir), raw.team_documents(spark, sf_dir), root
    )
    absent = [c for c in [*schemas.TEAM_COUNT_FIELDS, *schemas.TEAM_PERCENT_FIELDS] if c not in ("FGM", "FG_PCT")]
    teams = tables.scan_dim(spark, f"{root}/teams").select(
        F.lit("teams").alias("table"), F.col("GAME_ID").alias("id"), F.col("TEAM_ID").alias("item"),
        F.col("TEAM_NAME").alias("name"), F.col("GAME_DATE").alias("day"), F.col("PTS").alias("n"),
        F.col("PLUS_MINUS").alias("amount"), F.col("TEAM_ABBREVIATION").alias("a"), F.col("SEASON_ID").alias("b"),
        F.col("MATCHUP").alias("matchup"), F.col("WL").alias("wl"), F.col("MIN").alias("minutes"),
        F.col("FGM").alias("fgm"), F.col("FG_PCT").alias("fg_pct"),
        sum(F.col(c).isNull().cast("int") for c in absent).alias("n_absent"),
    )
    players = tables.scan_dim(spark, f"{root}/players").select(
        F.lit("players").alias("table"), F.col("id").cast("bigint").alias("item"),
        F.col("full_name").alias("name"), "is_active", F.col("first_name").alias("a"), F.col("last_name").alias("b"),
    )
    return teams.unionByName(players, allowMissingColumns=True)


def written_dims(spark, sf_dir, root):
    """(players, team histories) as stored silver tables."""
    silver.build_dims_silver(
        spark, raw.player_items(spark, sf_dir), raw.team_documents(spark, sf_dir), root
    )
    return tables.scan_dim(spark, f"{root}/players"), tables.scan_dim(spark, f"{root}/teams")


# ---- gold ----------------------------------------------------------------

def dimension_union(gold_store):
    players = store.scan_gold(gold_store, "players").select(
        F.lit("players").alias("table"), F.col("player_id").cast("string").alias("id"),
        F.col("first_name").alias("a"), F.col("last_name").alias("b"),
        F.col("is_active").cast("int").alias("n"),
    )
    teams = store.scan_gold(gold_store, "teams").select(
        F.lit("teams").alias("table"), F.col("id").cast("string").alias("id"),
        F.col("abbreviation").alias("a"), F.col("team_name").alias("b"),
    )
    games = store.scan_gold(gold_store, "games").select(
        F.lit("games").alias("table"), F.col("game_id").alias("id"),
        F.col("game_date").cast("string").alias("a"), F.col("season_id").alias("n"),
    )
    return players.unionByName(teams, True).unionByName(games, True)


@query("load_dimensions", f"""
WITH {raw.TEAM_GAMES_SQL}
SELECT 'players' AS "table", (c_custkey * 4 + 1)::VARCHAR AS id, 'F' || c_custkey AS a, 'L' || c_nationkey AS b,
       (c_acctbal > 0)::INT AS n FROM customer
UNION ALL SELECT DISTINCT 'teams', team_id::VARCHAR, 'T' || team_id, team_name, NULL::INT FROM team_games
UNION ALL SELECT DISTINCT 'games', game_id, game_date::VARCHAR, NULL, year(game_date)::INT FROM team_games
""")
def load_dimensions(spark, sf_dir):
    root, gold_store = new_store(spark)
    gold.load_dimensions(gold_store, *written_dims(spark, sf_dir, root))
    return dimension_union(gold_store)


@query("load_team_stats", f"""
WITH {raw.TEAM_GAMES_SQL}
SELECT game_id, team_id::INT AS team_id, 'A vs. B' AS matchup, wl, 240::DECIMAL(8,2) AS minutes, pts::INT AS pts,
       (k % 21 - 10)::INT AS plus_minus, NULL::DECIMAL(8,3) AS pace
FROM team_games WHERE st <> 'P'
""")
def load_team_stats(spark, sf_dir):
    root, gold_store = new_store(spark)
    _, team_games = written_dims(spark, sf_dir, root)
    gold.load_dimensions(gold_store, None, team_games, with_games=False)
    # Pending games are not in the dimension, so their rows are dropped.
    known = raw.games(spark, sf_dir).where("st <> 'P'")
    store.append_absent(gold_store, "games", known.select(
        "game_id", season_of_date("game_date").alias("season_id"), "game_date"
    ))
    gold.load_team_stats(gold_store, team_games)
    return store.scan_gold(gold_store, "fact_team_stats").select(
        "game_id", "team_id", "matchup", "wl", "minutes", "pts", "plus_minus", "pace"
    )


def fact_union(gold_store):
    """The three dated facts in common columns."""
    stats = store.scan_gold(gold_store, "fact_player_stats").select(
        F.lit("player_stats").alias("table"), "game_id", F.lit(None).cast("int").alias("item"),
        "player_id", "team_id", F.col("minutes").cast("double").alias("amount"),
        F.col("off_rating").cast("double").alias("other"), F.col("start_position").alias("label"),
    )
    plays = store.scan_gold(gold_store, "fact_play_by_play").select(
        F.lit("play_by_play").alias("table"), "game_id", F.col("action_number").alias("item"),
        "player_id", "team_id", F.col("clock_seconds").cast("double").alias("amount"),
        F.col("shot_distance").cast("double").alias("other"), F.col("description").alias("label"),
    )
    shots = store.scan_gold(gold_store, "fact_shots").select(
        F.lit("shots").alias("table"), "game_id", F.col("game_event_id").alias("item"),
        "player_id", "team_id", F.col("loc_x").cast("double").alias("amount"),
        F.col("loc_y").cast("double").alias("other"), F.col("shot_zone_basic").alias("label"),
    )
    return stats.unionByName(plays).unionByName(shots)


FACTS_SQL = SILVER_SQL + """,
since AS (SELECT person_id, min(game_date) AS since FROM players_of GROUP BY ALL),
facts AS (
  SELECT 'player_stats' AS "table", game_id, game_date, st, NULL::INT AS item, person_id::INT AS player_id,
         team_id::INT AS team_id,
         CASE row_pos WHEN 0 THEN printf('%.2f', k % 48 + (k % 60)::DOUBLE / 60)::DOUBLE
           WHEN 1 THEN printf('%.2f', k % 48 + ((k % 60)::DOUBLE + 0.5::DOUBLE) / 60)::DOUBLE END AS amount,
         off_rating::DOUBLE AS other, position AS label
  FROM players_of
  UNION ALL
  SELECT 'play_by_play', game_id, game_date, st, action_number, nullif(player, 0), nullif(team, 0), clock_seconds,
         shot_distance, description FROM actions_of WHERE st <> 'P'
  UNION ALL
  SELECT 'shots', game_id, game_date, st, event, player, team, x, y, zone
  FROM shots_of JOIN since ON player = person_id AND since <= game_date WHERE st <> 'P'
)"""
FACT_COLUMNS = """ "table", game_id, item::INT AS item, player_id::INT AS player_id, team_id::INT AS team_id, amount, other, label """


@query("load_facts", f"WITH {FACTS_SQL} SELECT {FACT_COLUMNS} FROM facts")
def load_facts(spark, sf_dir):
    root, gold_store = new_store(spark)
    built = silver.build_silver(raw.entries(spark, sf_dir), raw.all_documents(spark, sf_dir))
    silver.write_silver(built, root)
    gold.load_facts(spark, gold_store, {d: tables.scan_silver(spark, root, d) for d in DATASETS})
    return fact_union(gold_store)


@query("load_dates", f"WITH {FACTS_SQL} SELECT {FACT_COLUMNS} FROM facts")
def load_dates(spark, sf_dir):
    """Stored silver, the later half of the dates first; every fifth date has lost its manifest."""
    root, gold_store = new_store(spark)
    built = silver.build_silver(raw.entries(spark, sf_dir), raw.all_documents(spark, sf_dir))
    silver.write_silver(built, root)
    manifests = raw.manifests(spark, sf_dir)
    dates = manifests.select("game_date").distinct()
    manifests = manifests.where(F.month("game_date") % 5 != 0)
    middle = F.lit("1998-04-01").cast("date")
    for half in (F.col("game_date") >= middle, F.col("game_date") < middle):
        jobs.load_dates(spark, root, gold_store, manifests, dates.where(half))
    return fact_union(gold_store)


@query("fact_rejects", f"""
WITH {FACTS_SQL}
SELECT 'fact_shots' AS "table", fk, key, count(*) AS n FROM (
  SELECT 'games' AS fk, game_id AS key FROM shots_of WHERE st = 'P'
  UNION ALL
  SELECT 'players', player::VARCHAR FROM shots_of LEFT JOIN since ON player = person_id
  WHERE since IS NULL OR since > game_date)
GROUP BY ALL
""")
def fact_rejects(spark, sf_dir):
    root, gold_store = new_store(spark)
    built = silver.build_silver(raw.entries(spark, sf_dir), raw.all_documents(spark, sf_dir))
    silver.write_silver(built, root)
    stored = {d: tables.scan_silver(spark, root, d) for d in DATASETS}
    gold.load_facts(spark, gold_store, stored)
    return gold.fact_rejects(gold_store, "fact_shots", stored["shot_chart"])


@query("load_stubs", f"""
WITH {SILVER_SQL},
first_p AS (SELECT * FROM players_of QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY game_date, k, row_pos) = 1),
first_t AS (SELECT * FROM players_of QUALIFY row_number() OVER (PARTITION BY team_id ORDER BY game_date, k, row_pos) = 1)
SELECT 'players' AS "table", person_id::VARCHAR AS id, first_name AS a, family_name AS b, 1 AS n FROM first_p
UNION ALL SELECT 'teams', team_id::VARCHAR, tricode, tricode, NULL FROM first_t
UNION ALL SELECT 'games', game_id, game_date::VARCHAR, NULL, season FROM season_g WHERE st <> 'P'
""")
def load_stubs(spark, sf_dir):
    root, gold_store = new_store(spark)
    docs = {"boxscores": raw.documents(spark, sf_dir, "boxscores")}
    silver.write_silver(silver.build_silver(raw.entries(spark, sf_dir), docs), root)
    gold.load_facts(spark, gold_store, {"boxscores": tables.scan_silver(spark, root, "boxscores")})
    return dimension_union(gold_store)


@query("incremental_run", f"WITH {FACTS_SQL} SELECT {FACT_COLUMNS} FROM facts")
def incremental_run_(spark, sf_dir):
    root, gold_store = new_store(spark)
    lake = shared_dir(spark, "manifests")
    worklist.write_manifests(raw.manifests(spark, sf_dir), lake)
    for _ in range(2):  # the second run finds nothing new
        incremental_run(
            spark, lake, documents_of(spark, sf_dir), root, gold_store, f"{lake}-checkpoint"
        ).awaitTermination()
    return fact_union(gold_store)


def _span(spark, sf_dir):
    return raw.games(spark, sf_dir).select("game_date").distinct()


@query("backfill", f"""
WITH {FACTS_SQL},
d AS (SELECT game_date, count(*) FILTER (WHERE st <> 'P') AS n FROM g GROUP BY ALL)
SELECT {FACT_COLUMNS}, (SELECT count(*) + count(*) FILTER (WHERE n = 0) FROM d)::BIGINT AS processed FROM facts
""")
def backfill(spark, sf_dir):
    root, gold_store = new_store(spark)
    summary, _ = jobs.backfill(
        spark, raw.manifests(spark, sf_dir), documents_of(spark, sf_dir), root, gold_store,
        _span(spark, sf_dir),
    )
    processed = summary.first().processed
    # The second run skips all dates but those without any box score, which count
    # as open until one arrives.
    again, _ = jobs.backfill(
        spark, raw.manifests(spark, sf_dir), documents_of(spark, sf_dir), root, gold_store,
        _span(spark, sf_dir),
    )
    return fact_union(gold_store).withColumn(
        "processed", F.lit(processed + again.first().processed).cast("bigint")
    )


# ---- failures -------------------------------------------------------------

BROKEN = '{"boxScoreAdvanced":'


def box_scores(spark, sf_dir, mended):
    """Box scores alone, one in 97 cut off unless they are mended: (documents_of, unreadable_of)."""
    texts = raw.boxscore_texts(spark, sf_dir)
    cut = (F.col("game_id").cast("bigint") % 97 == 5) & F.lit(not mended)
    named = texts.select(F.col("game_id").alias("file_key"), F.when(cut, BROKEN).otherwise(F.col("doc")).alias("doc"))
    docs = documents.parse_documents(named, "doc", schemas.BOXSCORE_DOC)
    return (
        lambda _session, _entries: {"boxscores": documents.split_corrupt(docs)[0]},
        lambda _session, entries: silver.unreadable_documents(docs, "boxscores", entries),
    )


@query("backfill_outcomes", f"""
WITH {raw.GAMES_SQL},
d AS (SELECT game_date, count(*) FILTER (WHERE k % 97 = 5) AS broken, count(*) FILTER (WHERE st <> 'P') AS n
      FROM g GROUP BY ALL)
SELECT 1 AS run, game_date, CASE WHEN broken > 0 THEN 'failed' ELSE 'processed' END AS status FROM d
UNION ALL
SELECT 2, game_date, CASE WHEN broken > 0 THEN 'failed' WHEN n > 0 THEN 'skipped' ELSE 'processed' END FROM d
UNION ALL
SELECT 3, game_date, CASE WHEN broken > 0 OR n = 0 THEN 'processed' ELSE 'skipped' END FROM d
""")
def backfill_outcomes(spark, sf_dir):
    """Two runs over broken box scores and one over mended ones; a date without box scores stays open."""
    root, gold_store = new_store(spark)
    found = None
    for run, mended in enumerate((False, False, True), 1):
        statuses, _ = jobs.backfill_dates(
            spark, raw.manifests(spark, sf_dir), box_scores(spark, sf_dir, mended)[0], root, gold_store,
            _span(spark, sf_dir), unreadable_of=box_scores(spark, sf_dir, mended)[1])
        rows = statuses.select(F.lit(run).alias("run"), "game_date", "status")
        found = rows if found is None else found.unionByName(rows)
    return found


@query("quarantine_rows", f"""
WITH {raw.GAMES_SQL}
SELECT 'boxscores' AS dataset, game_id AS file_key, game_date, NULL::BIGINT AS row_pos, 'malformed' AS reason,
       true AS fails, '{BROKEN}' AS detail FROM g WHERE k % 97 = 5
UNION ALL
SELECT 'boxscores', game_id, game_date, (1::BIGINT << 40) + 1, 'an id is no integer', false, c || '.5'
FROM g WHERE k % 97 <> 5 AND st <> 'P'
""")
def quarantine_rows(spark, sf_dir):
    """What stands rejected after two runs over broken box scores."""
    root, gold_store = new_store(spark)
    docs, unreadable = box_scores(spark, sf_dir, False)
    for force in (False, True):
        jobs.backfill_dates(spark, raw.manifests(spark, sf_dir), docs, root, gold_store, _span(spark, sf_dir), force,
                            unreadable)
    detail = F.coalesce(F.get_json_object("text", "$.PERSON_ID"), "text")
    return ledger.open_rejects(spark, root).select(
        "dataset", "file_key", "game_date", "row_pos", "reason", "fails", detail.alias("detail"))


@query("dims_refresh", f"""
WITH {raw.TEAM_GAMES_SQL},
{SILVER_SQL.replace(raw.GAMES_SQL + ',', '', 1)},
day AS (SELECT max(game_date) AS d FROM g),
p_day AS (SELECT * FROM players_of WHERE game_date = (SELECT d FROM day)),
all_games AS (SELECT game_id FROM team_games UNION SELECT game_id FROM p_day),
all_players AS (SELECT c_custkey * 4 + 1 AS id FROM customer UNION SELECT person_id FROM p_day)
SELECT 'games' AS "table", count(*) AS n_rows FROM all_games
UNION ALL SELECT 'players', count(*) FROM all_players
UNION ALL SELECT 'teams', count(*) FROM (SELECT team_id FROM team_games UNION SELECT team_id FROM p_day)
UNION ALL SELECT 'fact_team_stats', count(*) FROM team_games
UNION ALL SELECT 'fact_player_stats', count(*) FROM p_day
UNION ALL SELECT 'fact_play_by_play', count(*) FROM actions_of
  WHERE game_date = (SELECT d FROM day) AND game_id IN (FROM all_games)
UNION ALL SELECT 'fact_shots', count(*) FROM shots_of
  WHERE game_date = (SELECT d FROM day) AND game_id IN (FROM all_games) AND player IN (FROM all_players)
""")
def dims_refresh(spark, sf_dir):
    root, gold_store = new_store(spark)
    jobs.refresh_dimensions(
        spark, raw.player_items(spark, sf_dir), raw.team_documents(spark, sf_dir), root, gold_store
    )
    latest = raw.games(spark, sf_dir).agg(F.max("game_date")).first()[0]
    jobs.process_date(
        spark, raw.manifests(spark, sf_dir), documents_of(spark, sf_dir), root, gold_store, latest
    )
    return report.table_counts({
        name: store.scan_gold(gold_store, name) for name in store.GOLD
    })


@query("verify", f"""
WITH {FACTS_SQL},
d AS (SELECT DISTINCT game_date FROM g),
per AS (SELECT game_date, count(*) FILTER (WHERE "table" = 'player_stats') AS a,
               count(*) FILTER (WHERE "table" = 'play_by_play') AS b,
               count(*) FILTER (WHERE "table" = 'shots') AS c FROM facts GROUP BY ALL),
n AS (SELECT game_date, count(*) AS n FROM g WHERE st <> 'P' GROUP BY ALL)
SELECT game_date::VARCHAR AS key, coalesce(n, 0) AS n_games, coalesce(a, 0) AS n_player_stats,
       coalesce(b, 0) AS n_play_by_play, coalesce(c, 0) AS n_shots
FROM d LEFT JOIN per USING (game_date) LEFT JOIN n USING (game_date)
UNION ALL
SELECT 'all', (SELECT count(*) FROM g WHERE st <> 'P'), sum(a)::BIGINT, sum(b)::BIGINT, sum(c)::BIGINT FROM per
UNION ALL
SELECT 'dimensions', (SELECT count(*) FROM g WHERE st <> 'P'), count(DISTINCT person_id), count(DISTINCT team_id), 0
FROM players_of
UNION ALL
SELECT 'samples', 0, 5, 5, 0
""")
def verify(spark, sf_dir):
    root, gold_store = new_store(spark)
    entries = raw.entries(spark, sf_dir)
    jobs.process_dates(spark, entries, raw.all_documents(spark, sf_dir), root, gold_store)
    found = jobs.verify(gold_store, _span(spark, sf_dir))
    dates = found["breakdown"].select(
        F.col("game_date").cast("string").alias("key"), "n_games", "n_player_stats",
        "n_play_by_play", "n_shots",
    )
    totals = found["counts"].groupBy(F.lit("all").alias("key")).pivot(
        "table", ["games", "fact_player_stats", "fact_play_by_play", "fact_shots"]
    ).agg(F.first("n_rows"))
    others = found["counts"].groupBy(F.lit("dimensions").alias("key")).pivot(
        "table", ["games", "players", "teams", "fact_team_stats"]
    ).agg(F.first("n_rows"))
    # A sample is random; what holds of any: five different rows of the fact that pass the filter.
    played = store.scan_gold(gold_store, "fact_player_stats").where("minutes > 0")
    told = store.scan_gold(gold_store, "fact_play_by_play").where("description != ''")
    samples = [(found[name].distinct().join(rows.select(*keys), keys, "left_semi").count()) for name, rows, keys in (
        ("player_sample", played, ["game_id", "player_id"]), ("play_sample", told, ["game_id", "description"]))]
    drawn = spark.createDataFrame([("samples", 0, *samples, 0)], dates.schema)
    return dates.unionByName(totals.toDF("key", *dates.columns[1:])).unionByName(
        others.toDF("key", *dates.columns[1:])).unionByName(drawn)


# ---- the flagship: dedupe, reference check, upsert, season totals --------

@query("season_totals", f"""
WITH {FK_SQL},
kept AS (SELECT * FROM flagged WHERE has_o AND has_p AND has_s
         QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) = 1),
s AS (SELECT l_orderkey AS k, sum(l_quantity) AS quantity FROM kept GROUP BY ALL),
m AS (SELECT o_orderkey, o_orderdate, coalesce(quantity, 0) AS quantity, quantity IS NOT NULL AS hit
      FROM orders LEFT JOIN s ON o_orderkey = k)
SELECT (CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT AS season,
       count(*) AS n_orders, count(*) FILTER (WHERE hit) AS n_updated, sum(quantity) AS quantity
FROM m GROUP BY ALL
""")
def season_totals(spark, sf_dir):
    from courtlake.operators.dedupe import keep_first
    from courtlake.operators.refs import fk_filter
    from courtlake.operators.upsert import upsert

    kept = fk_filter(lines(spark, sf_dir), line_references(spark, sf_dir))
    first = keep_first(
        kept, ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"],
    )
    source = first.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.lit(True).alias("hit")
    )
    target = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.lit(0.0).alias("quantity"), F.lit(False).alias("hit")
    )
    return upsert(target, source, ["o_orderkey"]).groupBy(
        season_of_date("o_orderdate").alias("season")
    ).agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if("hit").alias("n_updated"),
        F.sum("quantity").alias("quantity"),
    )
