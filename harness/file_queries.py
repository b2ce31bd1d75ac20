"""Scans of document files, one for each order date."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake.operators import flatten
from courtlake.sources import documents
from courtlake import schemas
from harness.files import files_by_date
from harness.registry import query, table

KEY = "o_orderkey"
BAD_SQL = """bad AS (
  SELECT DISTINCT o_orderdate FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW')"""
PLACE_SQL = "row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1"


def price():
    return F.col("o_totalprice").cast("string")


def broken():
    return (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")


@query("scan_nested_files", f"""
WITH {BAD_SQL}
SELECT strftime(o_orderdate, '%Y-%m-%d') AS game_id, 'HOME' AS side, o_orderkey::VARCHAR AS person,
  o_totalprice AS rating, ({PLACE_SQL})::BIGINT AS row_pos, false AS malformed
FROM orders ANTI JOIN bad USING (o_orderdate)
UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL, NULL, NULL, true FROM bad
""")
def scan_nested_files(spark, sf_dir):
    """Players of the box-score files; a file that breaks off is kept as malformed."""
    player = F.format_string('{"personId":%d,"statistics":{"offensiveRating":%s}}', KEY, price())
    path = files_by_date(
        spark, sf_dir, "boxscore-files", player, '{"boxScoreAdvanced":{"homeTeam":{"teamId":1,"players":[', ",",
        ']},"awayTeam":{"teamId":2,"players":[]}}}', broken())
    good, bad = documents.split_corrupt(documents.scan_boxscores(spark, path))
    rows = flatten.flatten_sides(good).select(
        F.col("file_key").alias("game_id"), "side", F.col("player")["personId"].alias("person"),
        F.col("statistics")["offensiveRating"].cast("double").alias("rating"), F.col("_row_pos").alias("row_pos"),
        F.lit(False).alias("malformed"))
    return rows.unionByName(
        bad.select(F.col("file_key").alias("game_id"), F.lit(True).alias("malformed")), allowMissingColumns=True)


@query("scan_actions_files", f"""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS game_id, ({PLACE_SQL})::INT AS pos,
  o_orderkey::VARCHAR AS action_number, 'PT' || (o_orderkey % 12) || 'M00.00S' AS clock
FROM orders
""")
def scan_actions_files(spark, sf_dir):
    action = F.format_string('{"actionNumber":%d,"clock":"PT%dM00.00S"}', KEY, F.col(KEY) % 12)
    path = files_by_date(spark, sf_dir, "action-files", action, '{"game":{"actions":[', ",", "]}}")
    docs = documents.scan_actions(spark, path)
    return docs.select("file_key", F.posexplode("game.actions").alias("pos", "action")).select(
        F.col("file_key").alias("game_id"), "pos",
        F.col("action")["actionNumber"].alias("action_number"), F.col("action")["clock"].alias("clock"))


@query("scan_array_files", f"""
WITH {BAD_SQL}
SELECT strftime(o_orderdate, '%Y-%m-%d') AS file, ({PLACE_SQL})::INT AS pos, o_orderkey AS id, o_totalprice AS price
FROM orders ANTI JOIN bad USING (o_orderdate)
UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL, NULL FROM bad
""")
def scan_array_files(spark, sf_dir):
    """Objects of the array files, and a row without object for each file that is no array."""
    item = F.format_string('{"id":%d,"price":%s}', KEY, price())
    path = files_by_date(spark, sf_dir, "array-files", item, "[", ",", "]", broken())
    rows = documents.scan_json_array(spark, path, "id bigint, price double")
    bad = documents.malformed_arrays(spark, path)
    file = F.regexp_replace("_file", r"\.json$", "").alias("file")
    return rows.select(file, F.col("_row_pos").alias("pos"), "id", "price").unionByName(
        bad.select(file), allowMissingColumns=True)


@query("scan_tolerant_files", f"""
WITH {BAD_SQL}
SELECT strftime(o_orderdate, '%Y-%m-%d') AS file, o_orderkey, o_totalprice FROM orders ANTI JOIN bad USING (o_orderdate)
UNION ALL SELECT strftime(o_orderdate, '%Y-%m-%d'), NULL, NULL FROM bad
""")
def scan_tolerant_files(spark, sf_dir):
    """Rows of files with a document a line; a file with a broken line is named, without its rows."""
    item = F.when(broken(), '{"key": 1, "price').otherwise(F.format_string('{"key":%d,"price":%s}', KEY, price()))
    path = files_by_date(spark, sf_dir, "line-files", item, "", "\n", "\n")
    lines = spark.read.text(path).select(
        F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("file"), "value")
    parsed = documents.parse_documents(lines, "value", "key bigint, price double")
    good, bad = documents.drop_failed_files(parsed, "file", F.col(documents.CORRUPT).isNotNull())
    return good.select(
        "file", F.col("key").alias("o_orderkey"), F.col("price").alias("o_totalprice")
    ).unionByName(bad, allowMissingColumns=True)


@query("scan_catalogued_files", """
SELECT strftime(o_orderdate, '%Y-%m-%d') AS game_id, count(*) AS n_actions FROM orders
GROUP BY o_orderdate HAVING count(*) FILTER (o_orderstatus = 'P') = 0
""")
def scan_catalogued_files(spark, sf_dir):
    """Only the files of dates without a pending order are on the list, and only they are opened."""
    action = F.format_string('{"actionNumber":%d}', KEY)
    path = files_by_date(spark, sf_dir, "listed-files", action, '{"game":{"actions":[', ",", "]}}")
    entries = table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("game_id")
    ).agg(F.count_if(F.col("o_orderstatus") == "P").alias("pending")).where("pending = 0")
    docs = documents.scan_documents(spark, path, schemas.ACTIONS_DOC, entries)
    return docs.select(F.col("file_key").alias("game_id"), F.size("game.actions").cast("bigint").alias("n_actions"))
