"""Operators on small tables: order, nulls, idempotence, refusals."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from courtlake.operators import contracts, dedupe, flatten, refs, report, sinks, upsert, worklist
from courtlake.schemas import Contract


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_keep_first_and_last(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), (None, 5, "n"), (None, 4, "m"), ("b", 3, "z")],
        "k string, pos int, v string",
    )
    first = dedupe.keep_first(df, ["k"], ["pos"])
    assert rows(first) == [(None, 4, "m"), ("a", 1, "y"), ("b", 3, "z")]
    assert rows(dedupe.keep_first(first, ["k"], ["pos"])) == rows(first)
    assert rows(dedupe.keep_last(df, ["k"], ["pos"])) == [(None, 5, "n"), ("a", 2, "x"), ("b", 3, "z")]
    assert dedupe.duplicate_count(df, ["k"]).first().n_duplicates == 2
    assert rows(dedupe.distinct_keys(df, "k")) == [("a",), ("b",)]


def test_one_row_per_key_crosses_the_shuffle(spark):
    """A hot key is cut to one row per task before it is exchanged."""
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = dedupe.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and exchange < partial


def test_unique_guard(spark):
    good = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert rows(dedupe.assert_unique(good, ["k"])) == [(1, "a"), (2, None)]
    for bad in ([(1, "a"), (1, "b")], [(None, "a")]):
        source = spark.createDataFrame(bad, "k int, v string")
        with pytest.raises(Exception, match="key"):
            dedupe.assert_unique(source, ["k"]).select("k").collect()


def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, w int"
    )


def test_upsert(spark):
    source = spark.createDataFrame([(2, None), (4, "d")], "k int, v string")
    once = upsert.upsert(target(spark), source, ["k"])
    assert rows(once) == [(1, "a", 10), (2, None, 20), (3, "c", 30), (4, "d", None)]
    assert rows(upsert.upsert(once, source, ["k"])) == rows(once)
    with pytest.raises(Exception, match="repeated key"):
        upsert.upsert(target(spark), source.union(source), ["k"]).collect()
    with pytest.raises(ValueError):
        upsert.upsert(target(spark), source.withColumn("zzz", F.lit(1)), ["k"])


def test_upsert_of_keys_alone_and_insert_if_absent(spark):
    keys = spark.createDataFrame([(2,), (4,), (4,)], "k int")
    assert rows(upsert.upsert(target(spark), keys, ["k"]))[3] == (4, None, None)
    stubs = spark.createDataFrame([(4, "late", 2), (4, "early", 1), (1, "no", 0)], "k int, v string, pos int")
    result = upsert.insert_if_absent(target(spark), stubs, ["k"], ["pos"])
    assert rows(result) == [(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "early", None)]


def test_references(spark):
    staged = spark.createDataFrame(
        [(1, 1, "2024-01-01"), (2, 9, "2024-01-01"), (3, None, "2024-01-01"), (4, 2, "2024-01-01"),
         (5, 2, "2024-01-03")], "k int, ref int, game_date string",
    ).withColumn("game_date", F.col("game_date").cast("date"))
    dim = spark.createDataFrame([(1, None), (2, "2024-01-02"), (2, "2024-01-03")], "id int, since string")
    dim = dim.withColumn("since", F.col("since").cast("date"))
    plain = [refs.Reference("ref", dim, "id", "dim")]
    dated = [refs.Reference("ref", dim, "id", "dim", since="since")]
    assert [r.k for r in refs.fk_filter(staged, plain).orderBy("k").collect()] == [1, 4, 5]
    assert [r.k for r in refs.fk_filter(staged, dated).orderBy("k").collect()] == [1, 5]
    counts = upsert.upsert_counts(staged, dated, "t").first()
    assert (counts.staged, counts.loaded, counts.dropped) == (5, 2, 3)
    assert rows(refs.fk_rejects(staged, plain, "t"), "n", "key") == [
        ("t", "dim", None, 1), ("t", "dim", "9", 1)
    ]


def test_contract(spark):
    df = spark.createDataFrame(
        [("g", 1, 5.0, "7"), ("g", 1, math.nan, "x"), ("g", None, 99.0, "-1"), ("h", 2, None, None)],
        "g string, k int, v double, t string",
    )
    contract = Contract(("g", "k"), ("k", "v", "nope"), 3, (("v", 0, 10), ("t", 0, None), ("absent", 0, 1)))
    found = rows(contracts.issues(contracts.check_contract(df, contract, "src", "g"))
                 .select("source", "message"))
    assert found == [
        ("src/g", "DUPLICATE PK: 1 rows on ['g', 'k']"), ("src/g", "MISSING COLUMN: nope"),
        ("src/g", "NULL: k has 1/3 nulls"), ("src/g", "NULL: v has 1/3 nulls"),
        ("src/g", "RANGE: t has 1 values below 0"), ("src/g", "RANGE: v has 1 values above 10"),
        ("src/h", "MISSING COLUMN: nope"), ("src/h", "NULL: v has 1/1 nulls"),
        ("src/h", "ROW COUNT: 1 rows (expected ≥3)"),
    ]
    everything = contracts.check_contract(df.where("false"), Contract(min_rows=1), "empty")
    assert contracts.passed_failed(everything).first().failed == 1
    assert contracts.validation_report(
        contracts.check_contract(df.where("false"), contract, "src", "g")).count() == 0


def test_pct_null_of_an_empty_table(spark):
    row, = contracts.pct_null(target(spark).where("false"), ["v"]).collect()
    assert (row.n_null, row.n_total, row.pct_null) == (0, 0, None)


def test_manifests_keep_order_and_empty_days(spark):
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string").select(
        F.col("d").cast("date").alias("game_date"))
    ids = spark.createDataFrame([("2024-01-01", p, f"id{p}") for p in (3, 0, 2, 1)],
                                "game_date string, pos int, game_id string")
    ids = ids.withColumn("game_date", F.col("game_date").cast("date"))
    whole = worklist.build_manifests(days, ids)
    assert [r.game_ids for r in whole.orderBy("game_date").collect()] == [["id0", "id1", "id2", "id3"], []]
    parts = worklist.build_manifests(days, ids, part_size=3)
    from courtlake.sources.documents import manifest_entries

    entries = manifest_entries(parts)
    assert rows(entries.select("manifest_pos", "game_id")) == [(p, f"id{p}") for p in range(4)]


def test_backfill_summary_lists_the_first_failures(spark):
    statuses = spark.createDataFrame(
        [(f"2024-01-{d:02d}", "failed" if d > 3 else "processed") for d in range(1, 11)],
        "game_date string, status string",
    )
    row = worklist.backfill_summary(statuses, listed=2).first()
    assert (row.total, row.processed, row.skipped, row.failed) == (10, 3, 0, 7)
    assert row.failed_dates == "2024-01-04, 2024-01-05"


def test_random_sample(spark):
    assert report.random_sample(spark.range(100), 5).count() == 5
    assert report.random_sample(spark.range(3), 5).count() == 3
    whole = spark.range(2000).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    sample = lambda df, seed: [r.id for r in report.random_sample(df, 9, seed).collect()]
    assert sample(whole, 1) == sample(whole.repartition(13), 1) != sample(whole, 2)
    halves = [report.random_sample(whole.where(f"id % 2 = {i}"), 9, 1) for i in (0, 1)]
    assert sample(halves[0].union(halves[1]), 1) == sample(whole, 1)


def shares(spark, df, path, columns):
    df.write.parquet(path)
    return {r.filtered: r.share for r in sinks.range_shares(spark.read.parquet(path), columns).collect()}


def test_clustered_files_serve_a_filter_on_each_column(spark, tmp_path):
    # x is skewed: half of the rows share one value.
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, 7, id * 7919 % 10007) AS x", "id * 104729 % 10009 AS y",
                                          "id AS _cell")
    both = shares(spark, sinks.clustered_layout(rows, ["x", "y"], 16), str(tmp_path / "z"), ["x", "y"])
    first = shares(spark, sinks.ordered_layout(rows, ["x", "y"]), str(tmp_path / "o"), ["x", "y"])
    assert both["x"] < 0.5 and both["y"] < 0.67 and first["y"] > 0.9
    stored = spark.read.parquet(str(tmp_path / "z"))
    assert stored.columns == ["x", "y", "_cell"] and stored.exceptAll(rows).isEmpty() and stored.count() == 20_000


def test_clustering_with_nulls_and_without_rows(spark):
    rows = spark.createDataFrame([(None, 1), (2, None), (2, None), (None, None)], "x int, y int")
    assert sinks.clustered_layout(rows, ["x", "y"], 4).exceptAll(rows).isEmpty()
    assert sinks.clustered_layout(rows.where("x > 5"), ["x", "y"], 4).count() == 0


def test_a_map_with_very_many_names_is_spread(spark):
    wide = spark.range(1).selectExpr("map_from_entries(transform(sequence(1, 3000), i -> (concat('k', i), i))) AS m")
    assert len(flatten.spread_map(wide, "m").columns) == 3000


def test_a_long_work_list_is_cut_by_games_and_written_once(spark, monkeypatch):
    from courtlake.sources import documents

    monkeypatch.setattr(documents, "SMALL_LIST_BYTES", 0)
    monkeypatch.setattr(documents, "PART_GAMES", 10)
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    day = F.lit("2020-01-01").cast("date").alias("game_date")
    entries = spark.range(200).select(
        day, F.col("id").alias("manifest_pos"), F.col("id").cast("string").alias("game_id"))
    listed = documents.listed_games(entries.mapInArrow(rows, entries.schema))
    docs = spark.range(0, 400, 2).select(F.col("id").cast("string").alias("file_key"))
    for _ in range(3):
        assert documents.on_list(docs, listed).count() == 100
    assert seen.value == 200
    assert listed.rdd.getNumPartitions() == 20


def test_documents_are_made_in_tasks_of_bounded_rows(spark, monkeypatch):
    from harness import raw

    monkeypatch.setattr(raw, "TASK_ROWS", 7)
    cores = spark.sparkContext.defaultParallelism
    wide = raw.spread(spark, spark.range(0, 70 * cores, 1, cores))
    assert wide.rdd.getNumPartitions() == 10 * cores and wide.distinct().count() == 70 * cores
    assert raw.spread(spark, spark.range(0, 3, 1, 1)).rdd.getNumPartitions() == cores


def test_a_report_computes_the_checked_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(1, 5), (1, 50), (2, None)], "k int, v int")
    results = contracts.check_contract(
        df.mapInArrow(rows, df.schema), Contract(primary_key=("k",), not_null=("v",), ranges=(("v", 0, 10),)), "t")
    lines = [r.line for r in contracts.validation_report(results).orderBy("seq").collect()]
    assert lines == ["checked 1, passed 0, failed 1", "DUPLICATE PK: 1 rows on ['k']", "NULL: v has 1/3 nulls",
                     "RANGE: v has 1 values above 10"]
    assert seen.value == 3
