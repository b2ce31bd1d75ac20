"""Keys, references, upserts, sinks, work lists and reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.functions.dates import date_sequence, season_of_date
from courtlake.operators import dedupe, flatten, refs, report, sinks, store, upsert, worklist
from courtlake.plans.jobs import plan_backfill
from courtlake.session import shared_dir
from courtlake.sources import tables
from harness.document_queries import DAYS_SQL, day_manifests
from harness.function_queries import SEASON_SQL
from harness.registry import query, refused, table

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount",
              "l_tax"]


def lines(spark, sf_dir):
    """Line items without negative zeros."""
    return table(spark, sf_dir, "lineitem").withColumn("l_discount", F.col("l_discount") + F.lit(0.0))


# ---- keep-first and duplicates -------------------------------------------

@query("dedupe_first", """
SELECT * REPLACE (l_discount + 0.0::DOUBLE AS l_discount, l_shipdate::DATE AS l_shipdate) FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax) = 1
""")
def dedupe_first(spark, sf_dir):
    return dedupe.keep_first(lines(spark, sf_dir), LINE_KEY, LINE_ORDER)


@query("duplicate_count", """
SELECT l_returnflag, (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS n_duplicates
FROM lineitem GROUP BY ALL
""")
def duplicate_count(spark, sf_dir):
    return dedupe.duplicate_count(lines(spark, sf_dir), LINE_KEY, by=["l_returnflag"])


@query("distinct_keys", "SELECT DISTINCT l_suppkey AS team_id FROM lineitem WHERE l_suppkey <> 0")
def distinct_keys(spark, sf_dir):
    teams = lines(spark, sf_dir).select(F.nullif("l_suppkey", F.lit(0)).alias("team_id"))
    return dedupe.distinct_keys(teams, "team_id")


@query("drop_null_key", "SELECT l_orderkey, l_suppkey AS team_id FROM lineitem WHERE l_suppkey <> 0")
def drop_null_key(spark, sf_dir):
    teams = lines(spark, sf_dir).select("l_orderkey", F.nullif("l_suppkey", F.lit(0)).alias("team_id"))
    return dedupe.drop_null_key(teams, ["team_id"])


@query("first_stub_wins", """
SELECT user_id, min(ts)::DATE AS since, arg_min(event_type, (ts, event_id)) AS event_type,
       arg_min(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY user_id
""")
def first_stub_wins(spark, sf_dir):
    stubs = dedupe.keep_first(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"])
    return stubs.select("user_id", F.col("ts").cast("date").alias("since"), "event_type", "event_id")


@query("last_load_wins", """
SELECT user_id, event_type, arg_max(value, (ts, event_id)) AS value,
       arg_max(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY user_id, event_type
""")
def last_load_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return dedupe.keep_last(events, ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "value", "event_id"
    )


# ---- references ----------------------------------------------------------

def line_references(spark, sf_dir) -> list[refs.Reference]:
    return [
        refs.Reference("l_orderkey", table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"),
                       "o_orderkey", "orders"),
        refs.Reference("l_partkey", table(spark, sf_dir, "part").where("p_size <= 25"),
                       "p_partkey", "part"),
        refs.Reference("l_suppkey", table(spark, sf_dir, "supplier").where("s_acctbal > 0"),
                       "s_suppkey", "supplier"),
    ]


FK_SQL = """
fo AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
fp AS (SELECT p_partkey FROM part WHERE p_size <= 25),
fs AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0),
flagged AS (
  SELECT *, l_orderkey IN (SELECT * FROM fo) AS has_o, l_partkey IN (SELECT * FROM fp) AS has_p,
         l_suppkey IN (SELECT * FROM fs) AS has_s
  FROM lineitem)"""


@query("fk_filter", f"""
WITH {FK_SQL}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM flagged WHERE has_o AND has_p AND has_s
""")
def fk_filter(spark, sf_dir):
    kept = refs.fk_filter(lines(spark, sf_dir), line_references(spark, sf_dir))
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query("fk_rejects", f"""
WITH {FK_SQL}
SELECT 'lineitem' AS "table", 'orders' AS fk, l_orderkey::VARCHAR AS key, count(*) AS n FROM flagged WHERE NOT has_o GROUP BY ALL
UNION ALL SELECT 'lineitem', 'part', l_partkey::VARCHAR, count(*) FROM flagged WHERE NOT has_p GROUP BY ALL
UNION ALL SELECT 'lineitem', 'supplier', l_suppkey::VARCHAR, count(*) FROM flagged WHERE NOT has_s GROUP BY ALL
""")
def fk_rejects(spark, sf_dir):
    return refs.fk_rejects(lines(spark, sf_dir), line_references(spark, sf_dir), "lineitem")


@query("upsert_counts", f"""
WITH {FK_SQL}
SELECT 'lineitem' AS "table", count(*) AS staged, count(*) FILTER (WHERE has_o AND has_p AND has_s) AS loaded,
       count(*) FILTER (WHERE NOT (has_o AND has_p AND has_s)) AS dropped
FROM flagged
""")
def upsert_counts(spark, sf_dir):
    return upsert.upsert_counts(lines(spark, sf_dir), line_references(spark, sf_dir), "lineitem")


# ---- upserts -------------------------------------------------------------

def loaded_orders(spark, sf_dir):
    """Orders loaded earlier: all but those still pending."""
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")


def resent_orders(spark, sf_dir):
    """A later delivery per order, from its line items: no customer, status or date."""
    return lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("o_totalprice"),
        F.when(F.max("l_linenumber") < 7, "RESENT").alias("o_orderpriority"),
    )


@query("upsert", """
WITH t AS (SELECT * REPLACE (o_orderdate::DATE AS o_orderdate) FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT l_orderkey AS k, sum(l_quantity) AS price,
             CASE WHEN max(l_linenumber) < 7 THEN 'RESENT' END AS priority FROM lineitem GROUP BY ALL)
SELECT coalesce(o_orderkey, k) AS o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN k IS NOT NULL THEN price ELSE o_totalprice END AS o_totalprice, o_orderdate,
       CASE WHEN k IS NOT NULL THEN priority ELSE o_orderpriority END AS o_orderpriority
FROM t FULL JOIN s ON o_orderkey = k
""")
def upsert_(spark, sf_dir):
    return upsert.upsert(loaded_orders(spark, sf_dir), resent_orders(spark, sf_dir), ["o_orderkey"])


@query("upsert_key_only", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT DISTINCT l_orderkey, NULL::BIGINT FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def upsert_key_only(spark, sf_dir):
    target = loaded_orders(spark, sf_dir).select("o_orderkey", "o_custkey")
    source = lines(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.upsert(target, source, ["o_orderkey"])


@query("insert_if_absent", """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_returnflag) = 1)
SELECT * FROM t UNION ALL SELECT s.* FROM s ANTI JOIN t ON o_orderkey = l_orderkey
""")
def insert_if_absent(spark, sf_dir):
    target = loaded_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderpriority")
    stubs = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"),
        F.col("l_returnflag").alias("o_orderpriority"), "l_linenumber", "l_shipdate", "l_partkey",
    )
    order = ["l_linenumber", "l_shipdate", "l_partkey", "o_custkey", "o_orderpriority"]
    return upsert.insert_if_absent(target, stubs, ["o_orderkey"], order)


@query("upsert_cardinality_guard", """
SELECT o_orderkey, o_custkey, o_totalprice,
       (SELECT (count(*) > count(DISTINCT o_custkey))::INT + (count(*) > 0)::INT FROM orders) AS refused
FROM orders
""")
def upsert_cardinality_guard(spark, sf_dir):
    """Unique keys pass; sources with a repeated key and with a null key are refused."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    by_customer = dedupe.assert_unique(orders.withColumn("o_orderkey", F.col("o_custkey")), ["o_orderkey"])
    first = orders.agg(F.min("o_orderkey")).first()[0]
    with_null = orders.withColumn("o_orderkey", F.nullif("o_orderkey", F.lit(first)))
    n = refused(by_customer, "repeated key") + refused(dedupe.assert_unique(with_null, ["o_orderkey"]), "null in key")
    return dedupe.assert_unique(orders, ["o_orderkey"]).withColumn("refused", F.lit(n))


# ---- projections and unions ----------------------------------------------

@query("conform_rename", """
SELECT l_orderkey AS game_id, l_linenumber AS action_number, l_quantity AS shot_distance FROM lineitem
""")
def conform_rename(spark, sf_dir):
    return flatten.conform(lines(spark, sf_dir), {
        "game_id": "l_orderkey", "action_number": "l_linenumber", "shot_distance": "l_quantity",
    })


@query("conform_dim", "SELECT c_custkey AS player_id, c_name AS last_name FROM customer")
def conform_dim(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return flatten.conform(customers, {"player_id": "c_custkey", "last_name": "c_name"})


@query("concat_frames", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def concat_frames(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    return flatten.concat_frames(customers, suppliers)


@query("predicates", """
SELECT event_id, user_id FROM events
WHERE value > 0 AND event_type <> '' AND user_id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey <> 0)
""")
def predicates(spark, sf_dir):
    # A null in the list excludes nothing and matches nothing.
    listed = table(spark, sf_dir, "supplier").select(
        F.nullif("s_suppkey", F.lit(0)).alias("user_id")
    )
    events = table(spark, sf_dir, "events").where((F.col("value") > 0) & (F.col("event_type") != ""))
    return events.join(listed, "user_id", "left_semi").select("event_id", "user_id")


# ---- sinks and table scans -----------------------------------------------

ORDERS_DDL = "o_orderkey bigint, o_totalprice double"


def _partitioned_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", season_of_date("o_orderdate").alias("season"),
        F.trunc("o_orderdate", "MM").alias("game_date"),
    )


@query("write_partitioned", f"""
SELECT o_orderkey, {SEASON_SQL} AS season, date_trunc('month', o_orderdate)::DATE AS game_date,
       CASE WHEN {SEASON_SQL} >= 1999 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders
""")
def write_partitioned(spark, sf_dir):
    path, orders = shared_dir(spark, "orders"), _partitioned_orders(spark, sf_dir)
    sinks.write_partitioned(orders, path)
    # Only the partitions of the later seasons are replaced.
    again = orders.where("season >= 1999").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_partitioned(again, path)
    return tables.scan_partitioned(spark, path, ORDERS_DDL)


@query("scan_partition", f"""
SELECT o_orderkey, o_totalprice, {SEASON_SQL} AS season, date_trunc('month', o_orderdate)::DATE AS game_date
FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)
""")
def scan_partition(spark, sf_dir):
    path, orders = shared_dir(spark, "orders"), _partitioned_orders(spark, sf_dir)
    sinks.write_partitioned(orders, path)
    latest = orders.agg(F.max("game_date")).first()[0]
    found = tables.only_date(tables.scan_partitioned(spark, path, ORDERS_DDL), latest)
    # A dataset that does not exist adds nothing.
    absent = tables.scan_partitioned(spark, f"{path}-absent", ORDERS_DDL)
    return found.unionByName(tables.only_date(absent, latest))


@query("write_dim", "SELECT c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer")
def write_dim(spark, sf_dir):
    path = shared_dir(spark, "customers")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    sinks.write_dim(customers, path)
    sinks.write_dim(customers.withColumn("c_acctbal", F.col("c_acctbal") + 1), path)
    return spark.read.parquet(path)


@query("scan_parquet_dim", "SELECT * FROM supplier")
def scan_parquet_dim(spark, sf_dir):
    return tables.scan_dim(spark, f"{sf_dir}/supplier.parquet")


@query("create_tables", """
SELECT c_custkey::INT AS player_id, c_name AS first_name, c_mktsegment AS last_name, c_acctbal > 0 AS is_active
FROM customer
""")
def create_tables(spark, sf_dir):
    root = shared_dir(spark, "gold")
    gold = store.create_tables(spark, root, fact_buckets=4)
    store.merge_table(gold, "players", table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"), (F.col("c_acctbal") > 0).alias("is_active"),
    ))
    # Creating again keeps what is there.
    return store.scan_gold(store.create_tables(spark, root), "players")


@query("scan_gold", f"""
SELECT o_orderkey::VARCHAR AS game_id, {SEASON_SQL} AS season_id, o_orderdate::DATE AS game_date FROM orders
""")
def scan_gold(spark, sf_dir):
    gold = store.create_tables(spark, shared_dir(spark, "gold"), fact_buckets=4)
    store.append_absent(gold, "games", table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"), season_of_date("o_orderdate").alias("season_id"),
        F.col("o_orderdate").alias("game_date"),
    ))
    return store.scan_gold(gold, "games")


@query("ordered_layout", """
SELECT l_orderkey AS game_id, l_linenumber AS period, l_quantity AS clock_seconds, l_partkey FROM lineitem
""")
def ordered_layout(spark, sf_dir):
    path = shared_dir(spark, "plays")
    plays = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("game_id"), F.col("l_linenumber").alias("period"),
        F.col("l_quantity").alias("clock_seconds"), "l_partkey",
    )
    sinks.write_dim(sinks.ordered_layout(plays, sinks.play_order()), path)
    return spark.read.parquet(path)


CLUSTER_FILES = 16


@query("clustered_layout", """
SELECT 'l_orderkey' AS filtered, count(*) AS n_rows, true AS skips_files FROM lineitem
UNION ALL SELECT 'l_partkey', count(*), true FROM lineitem
""")
def clustered_layout(spark, sf_dir):
    """Whether a filter on either key leaves out a third of the files or more."""
    path = shared_dir(spark, "clustered")
    rows = lines(spark, sf_dir).select("l_orderkey", "l_partkey", "l_quantity")
    sinks.write_dim(sinks.clustered_layout(rows, ["l_orderkey", "l_partkey"], CLUSTER_FILES), path)
    shares = sinks.range_shares(spark.read.parquet(path), ["l_orderkey", "l_partkey"])
    return shares.select("filtered", "n_rows", (F.col("share") * 3 <= 2).alias("skips_files"))


# ---- work lists ----------------------------------------------------------

def calendar(spark, sf_dir):
    """Every day from the first order to the last shipment."""
    first = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("first"), F.lit(1).alias("one"))
    last = lines(spark, sf_dir).agg(F.max("l_shipdate").alias("last"), F.lit(1).alias("one"))
    return date_sequence(first.join(last, "one"), "first", "last")


def written_dates(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return urgent.select(F.col("o_orderdate").alias("game_date")).distinct()


STATUS_SQL = f"""
{DAYS_SQL},
cal AS (SELECT unnest(generate_series((SELECT min(o_orderdate)::DATE FROM orders),
                                      (SELECT max(l_shipdate)::DATE FROM lineitem), INTERVAL 1 DAY))::DATE AS game_date),
o AS (SELECT DISTINCT o_orderdate::DATE AS game_date FROM orders),
w AS (SELECT DISTINCT o_orderdate::DATE AS game_date FROM orders WHERE o_orderpriority = '1-URGENT'),
status AS (
  SELECT game_date,
         CASE WHEN game_date NOT IN (FROM days) THEN 'failed'
              WHEN game_date NOT IN (FROM o) OR game_date IN (FROM w) THEN 'skipped'
              ELSE 'processed' END AS status
  FROM cal)"""


@query("pending_dates", f"WITH {STATUS_SQL} SELECT game_date FROM status WHERE status <> 'skipped'")
def pending_dates(spark, sf_dir):
    return worklist.pending_dates(
        calendar(spark, sf_dir), day_manifests(spark, sf_dir), written_dates(spark, sf_dir)
    )


@query("except_done", f"WITH {STATUS_SQL} SELECT game_date FROM cal WHERE game_date NOT IN (FROM o)")
def except_done(spark, sf_dir):
    done = table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("game_date"))
    return worklist.except_done(calendar(spark, sf_dir), done)


def backfill_statuses(spark, sf_dir):
    return plan_backfill(
        calendar(spark, sf_dir), day_manifests(spark, sf_dir), written_dates(spark, sf_dir)
    )


@query("plan_backfill", f"WITH {STATUS_SQL} SELECT game_date, status FROM status")
def plan_backfill_(spark, sf_dir):
    return backfill_statuses(spark, sf_dir)


@query("backfill_summary", f"""
WITH {STATUS_SQL}
SELECT count(*) AS total, count(*) FILTER (WHERE status = 'processed') AS processed,
       count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'failed') AS failed,
       (SELECT string_agg(game_date::VARCHAR, ', ' ORDER BY game_date)
        FROM (SELECT game_date FROM status WHERE status = 'failed' ORDER BY game_date LIMIT 30)) AS failed_dates
FROM status
""")
def backfill_summary(spark, sf_dir):
    return worklist.backfill_summary(backfill_statuses(spark, sf_dir))


@query("first_n", f"""
WITH {STATUS_SQL} SELECT game_date FROM status WHERE status = 'failed' ORDER BY game_date LIMIT 30
""")
def first_n(spark, sf_dir):
    failed = backfill_statuses(spark, sf_dir).where("status = 'failed'").select("game_date")
    return worklist.first_n(failed, "game_date", 30)


@query("missing_documents", """
SELECT o_orderkey::VARCHAR AS game_id, 'boxscores' AS dataset FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT o_orderkey::VARCHAR, 'shot_chart' FROM orders WHERE o_orderpriority = '5-LOW'
""")
def missing_documents(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    entries = orders.select(F.col("o_orderkey").cast("string").alias("game_id"))
    held = F.array_compact(F.array(
        F.when(F.col("o_orderstatus") != "P", "boxscores"), F.lit("pbp"),
        F.when(F.col("o_orderpriority") != "5-LOW", "shot_chart"),
    ))
    present = orders.select(
        F.col("o_orderkey").cast("string").alias("game_id"), F.explode(held).alias("dataset")
    )
    return worklist.missing_documents(entries, present)


# ---- reports -------------------------------------------------------------

def _games(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("game_id"), F.col("o_orderdate").alias("game_date")
    )


def _facts(spark, sf_dir):
    facts = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("game_id"), "l_partkey", "l_returnflag"
    )
    return {
        "player_stats": facts, "play_by_play": facts.where("l_returnflag = 'A'"),
        "shots": facts.where("l_returnflag = 'R'"),
    }


@query("table_counts", """
SELECT 'games' AS "table", count(*) AS n_rows FROM orders UNION ALL SELECT 'players', count(*) FROM customer
UNION ALL SELECT 'teams', count(*) FROM supplier UNION ALL SELECT 'facts', count(*) FROM lineitem
""")
def table_counts(spark, sf_dir):
    names = {"games": "orders", "players": "customer", "teams": "supplier", "facts": "lineitem"}
    return report.table_counts({k: table(spark, sf_dir, v) for k, v in names.items()})


@query("date_breakdown", f"""
WITH {DAYS_SQL},
g AS (SELECT o_orderkey AS k, o_orderdate::DATE AS game_date FROM orders WHERE o_orderstatus <> 'P'),
f AS (SELECT l_orderkey AS k, count(*) AS a, count(*) FILTER (WHERE l_returnflag = 'A') AS b,
             count(*) FILTER (WHERE l_returnflag = 'R') AS c FROM lineitem GROUP BY ALL),
d AS (SELECT game_date, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c FROM g LEFT JOIN f USING (k) GROUP BY ALL)
SELECT game_date, n IS NOT NULL AS has_games, coalesce(n, 0) AS n_games, coalesce(a, 0)::BIGINT AS n_player_stats,
       coalesce(b, 0)::BIGINT AS n_play_by_play, coalesce(c, 0)::BIGINT AS n_shots
FROM days LEFT JOIN d USING (game_date)
""")
def date_breakdown(spark, sf_dir):
    days = day_manifests(spark, sf_dir)
    return report.date_breakdown(days, _games(spark, sf_dir), _facts(spark, sf_dir))


@query("facts_for_date", """
SELECT l_orderkey AS game_id, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey IN
  (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderdate =
    (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus <> 'P'))
""")
def facts_for_date(spark, sf_dir):
    games = _games(spark, sf_dir)
    latest = games.agg(F.max("game_date")).first()[0]
    return report.facts_for_date(_facts(spark, sf_dir)["player_stats"], games, latest)


@query("random_sample", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 0
ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber, l_quantity LIMIT 5
""")
def random_sample(spark, sf_dir):
    played = lines(spark, sf_dir).where("l_quantity > 0")
    return report.random_sample(
        played.select("l_orderkey", "l_linenumber", "l_quantity"), 5, seed=7, keys=["l_orderkey", "l_linenumber"])
