"""Typed coercion, dates, durations and other column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.functions import dates, durations, numbers, text
from courtlake.operators import flatten
from courtlake.operators.store import typed_store
from courtlake.schemas import GoldTable
from harness.registry import query, refused, table

SEASON_SQL = "(CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END)::INT"


@query("season_of_date", f"SELECT o_orderkey, {SEASON_SQL} AS season FROM orders")
def season_of_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.season_of_date("o_orderdate").alias("season")
    )


@query("season_of_id", """
SELECT o_orderkey, '2' || year(o_orderdate) AS season_id, year(o_orderdate)::INT AS season FROM orders
""")
def season_of_id(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("2"), F.year("o_orderdate")).alias("season_id")
    )
    return ids.withColumn("season", dates.season_of_id("season_id"))


@query("date_sequence", """
SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS game_date
FROM orders
""")
def date_sequence(spark, sf_dir):
    span = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    return dates.date_sequence(span, "first", "last")


@query("parse_date", """
SELECT o_orderkey,
       CASE WHEN o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' THEN o_orderdate::DATE END AS day
FROM orders
""")
def parse_date(spark, sf_dir):
    written = (
        F.when(F.col("o_orderpriority") == "5-LOW", "unknown")
        .when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    return orders.select("o_orderkey", dates.parse_date("written").alias("day"))


@query("parse_date_lenient", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE END AS day FROM orders
""")
def parse_date_lenient(spark, sf_dir):
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate")
    written = (
        F.when(priority == "1-URGENT", F.date_format(day, "yyyy-MM-dd"))
        .when(priority == "2-HIGH", F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00")))
        .when(priority == "3-MEDIUM", F.date_format(day, "yyyyMMdd"))
        .when(priority == "5-LOW", F.lit("soon"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("written"))
    return orders.select("o_orderkey", dates.parse_date_lenient("written").alias("day"))


def _durations(spark, sf_dir):
    """A duration text per line item; its form depends on the line number."""
    q, second = F.col("l_quantity").cast("int"), F.col("l_suppkey") % 60
    padded = F.lpad(second.cast("string"), 2, "0")
    form = (
        F.when(F.col("l_linenumber") == 1, F.concat(q, F.lit(":"), padded))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("PT"), q, F.lit("M"), padded, F.lit(".50S")))
        .when(F.col("l_linenumber") == 3,
              F.concat(q, F.lit("."), F.lpad((F.col("l_partkey") % 1000).cast("string"), 3, "0")))
        .when(F.col("l_linenumber") == 4, F.lit(""))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit("-"), q, F.lit(":30:99")))
        .when(F.col("l_linenumber") == 6, F.lit("DNP"))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", form.alias("raw")
    )


@query("decimal_minutes", """
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE l_linenumber
    WHEN 1 THEN l_quantity::INT + (l_suppkey % 60)::DOUBLE / 60
    WHEN 2 THEN l_quantity::INT + ((l_suppkey % 60)::DOUBLE + 0.5::DOUBLE) / 60
    WHEN 3 THEN (l_quantity::INT || '.' || lpad((l_partkey % 1000)::VARCHAR, 3, '0'))::DOUBLE
    WHEN 5 THEN -(l_quantity::INT) + 0.5::DOUBLE END AS m
  FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, printf('%.2f', m)::DOUBLE + 0.0::DOUBLE AS minutes FROM x
""")
def decimal_minutes(spark, sf_dir):
    return _durations(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        (durations.decimal_minutes("raw") + F.lit(0.0)).alias("minutes"),
    )


@query("clock_seconds", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_linenumber = 2
            THEN l_quantity::INT::DOUBLE * 60 + (l_suppkey % 60)::DOUBLE + 0.5::DOUBLE END AS seconds
FROM lineitem
""")
def clock_seconds(spark, sf_dir):
    return _durations(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", durations.clock_seconds("raw").alias("seconds")
    )


@query("normalize_durations", """
SELECT count(*) FILTER (WHERE l_linenumber = 6) AS minutes_rejects,
       count(*) FILTER (WHERE l_linenumber IN (1, 3, 5, 6)) AS clock_rejects
FROM lineitem
""")
def normalize_durations(spark, sf_dir):
    raw = _durations(spark, sf_dir).select(F.col("raw").alias("minutes"), F.col("raw").alias("clock"))
    return durations.duration_rejects(raw, {"minutes": "minutes", "clock": "clock"})


def _texts(spark, sf_dir):
    """Number text per event; its form depends on the event type."""
    k = F.get_json_object("props", "$.k")
    cents = F.round(F.col("value") * 100).cast("bigint")
    written = (
        F.when(F.col("event_type") == "click", cents.cast("string"))
        .when(F.col("event_type") == "view", F.concat(F.lit("  "), k, F.lit(" ")))
        .when(F.col("event_type") == "purchase", F.concat(k, F.lit("e2")))
        .when(F.col("event_type") == "error", F.concat(F.lit("1_"), k))
        .when(k.cast("int") < 50, F.lit("true"))
        .when(k.cast("int") < 75, F.concat(k, F.lit(".5")))
        .when(k.cast("int") < 90, F.concat(k, F.lit("d")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", k.cast("int").alias("k"), written.alias("written")
    )


TEXTS_SQL = """
x AS (SELECT event_id, event_type, json_extract_string(props, '$.k')::INT AS k,
             round(value * 100)::BIGINT AS cents FROM events)"""


@query("coerce_double", f"""
WITH {TEXTS_SQL}
SELECT event_id, CASE event_type WHEN 'click' THEN cents::DOUBLE WHEN 'view' THEN k::DOUBLE
         WHEN 'purchase' THEN k * 100.0::DOUBLE WHEN 'error' THEN NULL
         ELSE CASE WHEN k < 50 THEN 1.0::DOUBLE WHEN k < 75 THEN k + 0.5::DOUBLE END END AS number
FROM x
""")
def coerce_double(spark, sf_dir):
    return _texts(spark, sf_dir).select(
        "event_id", numbers.coerce_double("written").alias("number")
    )


@query("coerce_long", f"""
WITH {TEXTS_SQL}
SELECT event_id, CASE event_type WHEN 'click' THEN cents WHEN 'view' THEN k::BIGINT
         WHEN 'purchase' THEN k::BIGINT * 100 WHEN 'signup' THEN CASE WHEN k < 50 THEN 1 END END AS number,
       event_type = 'signup' AND k >= 50 AND k < 75 AS is_fraction
FROM x
""")
def coerce_long(spark, sf_dir):
    return _texts(spark, sf_dir).select(
        "event_id", numbers.coerce_long("written").alias("number"),
        numbers.is_unsafe_long("written").alias("is_fraction"),
    )


@query("cast_int_strict", """
SELECT o_orderkey, o_custkey::INT AS customer,
       3 * (SELECT (count(*) > 0)::INT FROM orders WHERE o_custkey % 7 = 0) AS refused FROM orders
""")
def cast_int_strict(spark, sf_dir):
    """Integers pass; columns in which some are text, fractions or missing are refused."""
    orders, c = table(spark, sf_dir, "orders"), F.col("o_custkey").cast("string")
    some = F.col("o_custkey") % 7 == 0
    n = 0
    for bad, message in ((F.lit("x"), "CAST_INVALID_INPUT"), (F.concat(c, F.lit(".5")), "CAST_INVALID_INPUT"),
                         (F.lit(None).cast("string"), "null where an integer is required")):
        n += refused(orders.select(numbers.cast_int_strict(F.when(some, bad).otherwise(c))), message)
    return orders.select("o_orderkey", numbers.cast_int_strict(c).alias("customer"), F.lit(n).alias("refused"))


@query("truthy", f"""
WITH {TEXTS_SQL}
SELECT event_id, CASE WHEN event_type = 'error' THEN true ELSE k <> 0 END AS of_number,
       event_type NOT IN ('view', 'error') AS of_text,
       CASE WHEN event_type = 'view' THEN false ELSE k > 50 END AS of_boolean
FROM x
""")
def truthy(spark, sf_dir):
    number = F.when(F.col("event_type") != "error", F.col("k"))
    written = F.when(F.col("event_type") == "view", "").when(F.col("event_type") != "error", "0")
    flag = F.when(F.col("event_type") != "view", F.col("k") > 50)
    return _texts(spark, sf_dir).select(
        "event_id", numbers.truthy_number(number).alias("of_number"),
        numbers.truthy_text(written).alias("of_text"), numbers.truthy_bool(flag).alias("of_boolean"),
    )


@query("zero_to_null", f"WITH {TEXTS_SQL} SELECT event_id, nullif(k, 0) AS player_id FROM x")
def zero_to_null(spark, sf_dir):
    return _texts(spark, sf_dir).select(
        "event_id", numbers.zero_to_null("k").cast("int").alias("player_id")
    )


@query("trim_text", """
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS plain,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name ELSE 'None' END AS stringified
FROM customer
""")
def trim_text(spark, sf_dir):
    name = F.when(
        F.col("c_mktsegment") != "MACHINERY",
        F.concat(F.lit("\t  "), F.col("c_name"), F.lit(" \n")),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", text.strip_text(name).alias("plain"),
        text.strip_text(name, null_text="None").alias("stringified"),
    )


@query("typed_store", """
SELECT l_orderkey::INT AS game_id, (l_quantity / 8)::DECIMAL(8,2) AS minutes,
       (-l_extendedprice)::DECIMAL(10,2) AS loc_x, round_even(l_quantity / 2, 0)::INT AS pts,
       l_returnflag AS wl, l_shipdate::DATE AS game_date
FROM lineitem
""")
def typed_store_(spark, sf_dir):
    layout = GoldTable(
        {"game_id": "int", "minutes": "decimal(8,2)", "loc_x": "decimal(10,2)", "pts": "int",
         "wl": "char(1)", "game_date": "date"}, ("game_id",),
    )
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_id"), (F.col("l_quantity") / 8).alias("minutes"),
        (-F.col("l_extendedprice")).alias("loc_x"), (F.col("l_quantity") / 2).alias("pts"),
        F.col("l_returnflag").alias("wl"), F.col("l_shipdate").alias("game_date"),
    )
    return typed_store(raw, layout)


@query("json_path", """
SELECT event_id, json_extract_string(props, '$.k') AS k, NULL::VARCHAR AS absent, 0 AS n_tags FROM events
""")
def json_path(spark, sf_dir):
    doc = F.from_json("props", "k string, deep struct<name: string>, tags array<string>")
    return table(spark, sf_dir, "events").select("event_id", doc.alias("doc")).select(
        "event_id", F.col("doc.k").alias("k"), F.col("doc.deep.name").alias("absent"),
        F.size(text.or_empty("doc.tags")).alias("n_tags"),
    )


@query("stub_name", """
SELECT s_suppkey AS id, s_name AS abbreviation, s_name AS team_name FROM supplier
""")
def stub_name(spark, sf_dir):
    from courtlake.plans.gold import stub_name as named

    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), *named("s_name"))


@query("literal_side", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'HOME' ELSE 'AWAY' END AS team_type FROM orders
""")
def literal_side(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", flatten.literal_side(F.col("o_orderstatus") == "F").alias("team_type")
    )


@query("key_from_filename", "SELECT lpad(o_orderkey::VARCHAR, 10, '0') AS game_id, o_custkey FROM orders")
def key_from_filename(spark, sf_dir):
    path = F.format_string("lake/raw/boxscores/%010d.json", F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").select(
        text.key_from_path(path).alias("game_id"), "o_custkey"
    )
