"""Work that a job does once: manifests, team files."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.operators import store as st
from courtlake.plans import jobs, silver
from courtlake.sources.documents import parse_documents


def counted(spark, df):
    """The same rows, and an accumulator of how many have been computed."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(rows, df.schema), seen


def manifests(spark):
    return spark.createDataFrame(
        [("2020-01-01", 0, []), ("2020-01-02", 0, [])], "game_date string, first_pos bigint, game_ids array<string>"
    ).withColumn("game_date", F.col("game_date").cast("date"))


def test_manifests_are_worked_out_once(spark, tmp_path):
    gold = st.create_tables(spark, f"{tmp_path}/gold", fact_buckets=2)
    listed, seen = counted(spark, manifests(spark))
    documents_of = lambda _spark, _entries: {}
    assert jobs.process_date(spark, listed, documents_of, f"{tmp_path}/silver", gold, "2020-01-01") is None
    assert seen.value == 2
    dates = manifests(spark).select("game_date")
    statuses, _ = jobs.backfill_dates(spark, listed, documents_of, f"{tmp_path}/silver", gold, dates)
    assert {r.status for r in statuses.collect()} == {"skipped"}
    assert seen.value == 4


def test_team_files_are_decoded_once(spark):
    headers = '["TEAM_ID","GAME_ID","PTS"]'
    text = '{"resultSets":[{"name":"x","headers":%s,"rowSet":[[%s,"g1",5],[2,"g2",%s]]}]}'
    texts = spark.createDataFrame([
        ("a", text % (headers, 1, 6)), ("b", text % (headers, 3, "6.5")), ("c", text % (headers, '"x"', 7)),
        ("d", "{")], "file_key string, doc string")
    docs, seen = counted(spark, parse_documents(texts, "doc", schemas.RESULT_SET_DOC))
    table, failed = silver.team_games_table(docs)
    assert sorted((r.TEAM_ID, r.GAME_ID, r.PTS) for r in table.collect()) == [(1, "g1", 5), (2, "g2", 6)]
    assert seen.value == 4
    assert sorted((r.file_key, r.reason) for r in failed.collect()) == [
        ("b", "a row does not fit"), ("c", "a row does not fit"), ("d", "malformed")]
