"""A small raw lake on disk: scans, the two layers, backfill and incremental runs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from courtlake import schemas
from courtlake.operators import store as st
from courtlake.operators import ledger, worklist
from courtlake.plans import gold as gold_plan, jobs, silver
from courtlake.sources import documents, resultset, tables
from courtlake.streaming.incremental import incremental_lake_run


def player(pid, minutes="12:30", **stats):
    return {"personId": pid, "firstName": f"F{pid}", "familyName": f"L{pid}", "position": "G",
            "comment": "", "statistics": {"minutes": minutes, "offensiveRating": 100.5, **stats}}


def box(home, away, team=1):
    return {"boxScoreAdvanced": {
        "homeTeam": {"teamId": team, "teamTricode": "HOM", "players": home},
        "awayTeam": {"teamId": team + 1, "teamTricode": "AWY", "players": away}}}


def action(number, **extra):
    return {"actionNumber": number, "clock": "PT11M30.00S", "period": 1, "teamId": 0, "personId": 0,
            "actionType": "2pt", "subType": "", "description": f"d{number}", "shotDistance": 3,
            "scoreHome": "0", "scoreAway": "", "isFieldGoal": 1, **extra}


SHOT = ["GAME_ID", "GAME_EVENT_ID", "PLAYER_ID", "TEAM_ID", "PERIOD", "LOC_X", "LOC_Y", "SHOT_DISTANCE",
        "SHOT_ATTEMPTED_FLAG", "SHOT_MADE_FLAG", "GAME_DATE", "SHOT_ZONE_BASIC"]


def shots(*rows):
    body = [["x", event, pid, 1, 1, -12, 30.5, 4, 1, 0, "20240101", "Paint"] for event, pid in rows]
    return {"resource": "s", "resultSets": [{"name": "Detail", "headers": SHOT, "rowSet": body},
                                            {"name": "Other", "headers": ["A"], "rowSet": [[1]]}]}


def put(root, folder, name, doc):
    path = root / folder / f"{name}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(doc if isinstance(doc, str) else json.dumps(doc))


TEAM = ["TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID", "SEASON_ID", "GAME_DATE", "MATCHUP", "WL",
        "MIN", "PTS", "PLUS_MINUS", "FGM", "FG_PCT"]


def team_file(*rows):
    return {"resultSets": [{"name": "G", "headers": TEAM, "rowSet": [list(r) for r in rows]}]}


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    manifest = {"2024-01-01": ["001", "002"], "2024-01-02": [], "2024-01-03": ["003", "404"]}
    for day, ids in manifest.items():
        put(root, "manifests", day, {"game_date": day, "game_ids": ids})
    put(root, "boxscores", "001", box([player(1), player(1, "1:00"), player(2.5)], [player(3, "")]))
    put(root, "boxscores", "002", "{broken")
    put(root, "boxscores", "003", box([player(1, "PT5M30.00S"), player(4)], [], team=5))
    put(root, "boxscores", "000", " \n")
    put(root, "boxscores", "900", box([player(77)], []))  # on no manifest
    put(root, "pbp", "001", {"game": {"actions": [action(1), action(2, x=1), action(2)]}})
    put(root, "pbp", "002", {"game": {"actions": [action(1)]}})
    put(root, "pbp", "003", {"game": {"actions": []}})
    put(root, "shot_chart", "001", shots((10, 1), (11, 4), (12, 99)))
    put(root, "shot_chart", "003", shots((20, 4)))
    put(root, "players", "players", [
        {"id": 1, "full_name": " A B ", "first_name": "A", "last_name": "B", "is_active": False},
        {"id": 1, "full_name": "later", "first_name": "x", "last_name": "y", "is_active": True},
        {"id": 8, "full_name": "C", "first_name": "C", "last_name": None, "is_active": True}])
    good = (1, "HOM", "Homers", "001", "22023", "2024-01-01", "m", "W", 240, 101, 3, 40, 0.5)
    put(root, "teams", "1", team_file(good, good))
    put(root, "teams", "2", team_file((2, "AWY", "Aways", "001", "22023", "2024-01-01", "m", "L", 240,
                                       98, -3, 39.5, 0.4)))  # a fraction fails the whole file
    put(root, "teams", "3", "{broken")
    return root


def names(df, column):
    return sorted(r[0] for r in df.select(column).collect())


def test_scans(spark, lake):
    manifests = documents.scan_manifests(spark, f"{lake}/manifests")
    entries = documents.manifest_entries(manifests)
    assert sorted(tuple(r) for r in entries.select("manifest_pos", "game_id").collect()) == [
        (0, "001"), (0, "003"), (1, "002"), (1, "404")]
    good, bad = documents.split_corrupt(documents.scan_boxscores(spark, f"{lake}/boxscores"))
    assert names(good.where("boxScoreAdvanced IS NOT NULL"), "file_key") == ["001", "003", "900"]
    assert names(bad, "file_key") == ["000", "002"]
    one = entries.where("game_id = '001'")
    only = documents.scan_documents(spark, f"{lake}/pbp", schemas.ACTIONS_DOC, one)
    assert [f.rsplit("/", 1)[1] for f in only.inputFiles()] == ["001.json"]
    # A list of any length opens no other file.
    many = one.select("game_id").union(spark.range(10_001).select(F.format_string("x%d", "id"))).union(
        spark.createDataFrame([("003",)], "game_id string"))
    some = documents.scan_documents(spark, f"{lake}/boxscores", schemas.BOXSCORE_DOC, many)
    assert sorted(f.rsplit("/", 1)[1] for f in some.inputFiles()) == ["001.json", "003.json"]
    assert documents.scan_documents(spark, f"{lake}/pbp", schemas.ACTIONS_DOC, one.limit(0)).count() == 0
    sizes = {r.file_key: r.size for r in documents.list_documents(spark, f"{lake}/pbp").collect()}
    assert set(sizes) == {"001", "002", "003"} and all(sizes.values())
    assert names(only.where("game IS NOT NULL"), "file_key") == ["001"]
    missing = worklist.missing_documents(entries, worklist.present_documents(spark, str(lake)))
    assert sorted(tuple(r) for r in missing.collect()) == [
        ("002", "shot_chart"), ("404", "boxscores"), ("404", "pbp"), ("404", "shot_chart")]
    assert documents.scan_boxscores(spark, f"{lake}/nowhere").count() == 0
    assert silver.scan_players(spark, str(lake)).count() == 3


def test_result_sets(spark):
    doc = json.dumps({"resultSets": [
        {"name": "A", "headers": ["X", "Y"], "rowSet": [[1, "a"], [None, True], [0.5]]},
        {"name": "B", "headers": ["X"], "rowSet": [["b"]]}]})
    df = documents.parse_documents(spark.createDataFrame([(doc,)], "doc string"), "doc", schemas.RESULT_SET_DOC)
    df = df.drop(documents.CORRUPT)
    first = resultset.decode_resultset(df).orderBy("_row_pos").collect()
    assert [r.row for r in first] == [{"X": "1", "Y": "a"}, {"X": None, "Y": "true"}, None]
    assert resultset.decode_resultset(df, name="B").first().row == {"X": "b"}
    assert resultset.decode_resultset(df, name="C").count() == 0


def test_a_missing_manifest_is_an_error(spark, lake, tmp_path):
    manifests = documents.scan_manifests(spark, f"{lake}/manifests")
    gold = st.create_tables(spark, f"{tmp_path}/gold", 2)
    run = lambda day: jobs.process_date(
        spark, manifests, jobs.lake_documents(str(lake)), f"{tmp_path}/silver", gold, day)
    with pytest.raises(Exception, match="no manifest for 1999-01-01"):
        run("1999-01-01")
    assert run("2024-01-02") is None


def test_fractional_ids_are_kept_apart_or_refused(spark, lake):
    entries = documents.manifest_entries(documents.scan_manifests(spark, f"{lake}/manifests"))
    docs = silver.scan_raw(spark, str(lake), entries)
    built = silver.build_silver(entries, docs)
    assert built.quarantine["boxscores"].count() == 1
    assert names(built.rows["boxscores"], "PERSON_ID") == [1, 1, 3, 4]
    strict = silver.build_silver(entries, docs, strict=True)
    with pytest.raises(Exception, match="no integer"):
        strict.rows["boxscores"].collect()


GOLD_COLUMNS = {
    "games": ["game_id", "season_id", "game_date"], "players": ["player_id", "first_name", "is_active"],
    "teams": ["id", "abbreviation"], "fact_player_stats": ["game_id", "player_id", "minutes", "off_rating"],
    "fact_play_by_play": ["game_id", "action_number", "clock_seconds", "team_id", "description"],
    "fact_shots": ["game_id", "game_event_id", "player_id", "loc_x"],
}


def snapshot(gold):
    return {t: sorted(map(str, st.scan_gold(gold, t).select(*c).collect())) for t, c in GOLD_COLUMNS.items()}


def test_batch_equals_dates_in_turn_equals_stream(spark, lake, tmp_path):
    manifests = documents.scan_manifests(spark, f"{lake}/manifests")
    stores = {}
    for name in ("batch", "turn", "stream"):
        stores[name] = st.create_tables(spark, f"{tmp_path}/{name}/gold", 2)
    summary, report = jobs.backfill_lake(
        spark, str(lake), f"{tmp_path}/batch/silver", stores["batch"], "2024-01-01", "2024-01-04")
    row = summary.first()
    # The first date has a box score that can't be read, the last one no manifest.
    assert (row.total, row.processed, row.skipped, row.failed) == (4, 1, 1, 2)
    assert row.failed_dates == "2024-01-01, 2024-01-04"
    kept = ledger.open_rejects(spark, f"{tmp_path}/batch/silver").orderBy("file_key").collect()
    assert [(r.dataset, r.file_key, str(r.game_date), r.row_pos, r.fails) for r in kept] == [
        ("boxscores", "001", "2024-01-01", 2, False), ("boxscores", "002", "2024-01-01", None, True)]
    assert '"PERSON_ID":"2.5"' in kept[0].text and kept[1].text == "{broken"
    assert "checked" in report.where("source = '*'").first().line
    for day in ("2024-01-01", "2024-01-03"):
        jobs.process_date(spark, manifests, jobs.lake_documents(str(lake)), f"{tmp_path}/turn/silver",
                          stores["turn"], day)
    for _ in range(2):
        incremental_lake_run(spark, str(lake), f"{tmp_path}/stream/silver", stores["stream"],
                             f"{tmp_path}/stream/checkpoint")
    batch = snapshot(stores["batch"])
    assert batch == snapshot(stores["turn"]) == snapshot(stores["stream"])
    # Player 4 is first seen on the later date, so the earlier shot is dropped; 99 never is.
    assert [r.game_event_id for r in st.scan_gold(stores["batch"], "fact_shots")
            .orderBy("game_event_id").collect()] == [10, 20]
    # Game 002 has no readable box score, so its actions find no game.
    assert names(st.scan_gold(stores["batch"], "fact_play_by_play"), "game_id") == ["001", "001"]
    assert {str(r.minutes) for r in st.scan_gold(stores["batch"], "fact_player_stats").collect()} == {
        "12.50", "None", "5.50"}
    again, _ = jobs.backfill_lake(
        spark, str(lake), f"{tmp_path}/batch/silver", stores["batch"], "2024-01-01", "2024-01-03")
    assert (again.first().skipped, again.first().failed) == (2, 1)
    found = jobs.verify(stores["batch"], manifests)
    assert found["breakdown"].where("game_date = '2024-01-01'").first().n_shots == 1
    assert found["player_sample"].count() == 3 and found["play_sample"].count() == 2


def test_dimension_refresh(spark, lake, tmp_path):
    gold = st.create_tables(spark, f"{tmp_path}/gold", 2)
    jobs.refresh_lake(spark, str(lake), f"{tmp_path}/silver", gold, "2024-01-01")
    players = {r.player_id: r for r in st.scan_gold(gold, "players").collect()}
    assert players[1].is_active is False and players[8].last_name is None
    assert players[3].is_active is True  # a stub of the date's box score
    assert names(st.scan_gold(gold, "teams"), "id") == [1, 2]
    row, = st.scan_gold(gold, "fact_team_stats").collect()
    assert (row.game_id, row.team_id, row.pts, row.pace) == ("001", 1, 101, None)
    stored = tables.scan_dim(spark, f"{tmp_path}/silver/players")
    assert names(stored, "full_name") == ["A B", "C"]


def test_bad_dimensions_leave_the_old_tables(spark, lake, tmp_path, monkeypatch):
    root = f"{tmp_path}/s"
    players, teams = silver.scan_dims(spark, str(lake))
    silver.build_dims_silver(spark, players, teams, root)
    before = {t: sorted(map(str, spark.read.parquet(f"{root}/{t}").collect())) for t in ("players", "teams")}
    broken = tmp_path / "broken"
    put(broken, "players", "players", '[{"id": 1, "full_name"')
    with pytest.raises(ValueError, match="player"):
        silver.build_dims_silver(spark, silver.scan_players(spark, str(broken)), teams, root)
    with pytest.raises(ValueError, match="team"):
        silver.build_dims_silver(spark, players, teams.where("file_key <> '1'"), root)

    def lost(*_):
        raise OSError("driver lost")

    monkeypatch.setattr(silver, "switch_dim", lost)
    with pytest.raises(OSError):
        silver.build_dims_silver(spark, players.where("id = 8"), teams, root)
    assert before == {t: sorted(map(str, spark.read.parquet(f"{root}/{t}").collect())) for t in before}


def test_manifests_in_any_form(spark, tmp_path):
    put(tmp_path, "m", "a", json.dumps({"game_date": "2024-02-01", "game_ids": ["1"]}, indent=2))
    put(tmp_path, "m", "b", '{"game_date":"2024-02-02","first_pos":7,"game_ids":["2","3"]}\n'
                            '{"game_date":"2024-02-02","first_pos":0,"game_ids":["4"]}\n')
    put(tmp_path, "m", "c", '{"game_date":"2024-02-03","game_ids":["5"')
    put(tmp_path, "m", "d", '{"game_ids":["6"]}')
    path = str(tmp_path / "m")
    entries = documents.manifest_entries(documents.scan_manifests(spark, path))
    assert sorted((str(r.game_date), r.manifest_pos, r.game_id) for r in entries.collect()) == [
        ("2024-02-01", 0, "1"), ("2024-02-02", 0, "4"), ("2024-02-02", 7, "2"), ("2024-02-02", 8, "3")]
    assert names(documents.malformed_manifests(spark, path), "file_key") == ["c", "d"]


def test_contracts_of_a_game_on_two_dates(spark):
    rows = [("001", day, n, n) for day in ("2024-01-01", "2024-01-02") for n in range(1, 121)]
    pbp = spark.createDataFrame(rows, "GAME_ID string, game_date string, actionNumber bigint, period bigint")
    pbp = pbp.withColumn("clock_seconds", F.lit(1.0)).withColumn("period", F.lit(1).cast("bigint"))
    results = silver.validate_silver({"pbp": pbp}).collect()
    assert [r.n_total for r in results] == [120, 120]
    assert all(c.n_bad == 0 for r in results for c in r.checks if c.check == "pk_unique")


def test_silver_keeps_dates_it_has_no_rows_for(spark, lake, tmp_path):
    entries = documents.manifest_entries(documents.scan_manifests(spark, f"{lake}/manifests"))
    root = f"{tmp_path}/silver"
    silver.write_silver(silver.build_silver(entries, silver.scan_raw(spark, str(lake), entries)), root)
    first = entries.where(F.col("game_date") == "2024-01-03")
    silver.write_silver(silver.build_silver(first, silver.scan_raw(spark, str(lake), first)), root)
    assert tables.scan_silver(spark, root, "boxscores").count() == 4
    plan = tables.only_date(tables.scan_silver(spark, root, "boxscores"), "2024-01-03")
    assert plan.count() == 2
    assert "PartitionFilters: [isnotnull(season" in plan._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def two_dates(tmp_path_factory):
    """Players who come up on a later date only, and a game listed on both."""
    root = tmp_path_factory.mktemp("two")
    for day, ids in (("2024-01-01", ["001", "005"]), ("2024-01-03", ["003", "005"])):
        put(root, "manifests", day, {"game_date": day, "game_ids": ids})
    put(root, "boxscores", "001", box([player(1), player(7)], [player(3)]))
    put(root, "boxscores", "003", box([player(1, "PT5M30.00S"), player(4)], [player(7)], team=5))
    put(root, "boxscores", "005", box([player(9)], []))
    put(root, "shot_chart", "001", shots((10, 1), (11, 4)))
    put(root, "shot_chart", "003", shots((20, 4), (21, 7)))
    put(root, "shot_chart", "005", shots((30, 9), (31, 4)))
    return root


def test_order_batches_and_crashes_change_nothing(spark, two_dates, tmp_path, monkeypatch):
    import os

    root = str(two_dates)
    gold = lambda name: st.create_tables(spark, f"{tmp_path}/{name}/gold", 2)
    batch = gold("batch")
    jobs.backfill_lake(spark, root, f"{tmp_path}/batch/silver", batch, "2024-01-01", "2024-01-03")
    expected = snapshot(batch)
    assert [r.game_event_id for r in st.scan_gold(batch, "fact_shots").orderBy("game_event_id").collect()] == [
        10, 20, 21, 30, 31]
    files = sorted((two_dates / "manifests").glob("*.json"))
    for name, order, max_files in (("old-first", files, 1), ("new-first", files[::-1], 1), ("two", files, 2)):
        for at, file in enumerate(order):
            os.utime(file, (1_700_000_000 + at * 100,) * 2)
        store = gold(name)
        incremental_lake_run(spark, root, f"{tmp_path}/{name}/silver", store, f"{tmp_path}/{name}/check", max_files)
        assert snapshot(store) == expected, name

    def lost(*_args, **_more):
        raise OSError("driver lost")

    store = gold("crash")
    run = lambda: jobs.backfill_lake(
        spark, root, f"{tmp_path}/crash/silver", store, "2024-01-01", "2024-01-03", force=True)
    with monkeypatch.context() as m:
        m.setattr("courtlake.plans.gold.load_fact", lost)
        with pytest.raises(OSError):
            run()
    run()
    assert snapshot(store) == expected


def test_failures_stay_failures(spark, lake, tmp_path):
    """A date with a broken document is failed in every run until it is mended, then done."""
    import shutil

    root = shutil.copytree(lake, tmp_path / "raw")
    put(root, "boxscores", "404", box([player(5, comment=1)], []))
    put(root, "pbp", "404", {"game": {"actions": [action(1, period=1 << 40), action(2)]}})
    put(root, "manifests", "2024-01-05", '{"game_date": "2024-01-05", "game_ids": [')
    gold, silver_root = st.create_tables(spark, f"{tmp_path}/gold", 2), f"{tmp_path}/silver"

    def run():
        summary, _ = jobs.backfill_lake(spark, str(root), silver_root, gold, "2024-01-01", "2024-01-05")
        row = summary.first()
        return row.processed, row.skipped, row.failed_dates

    # Manifests of the 4th and 5th are missing or broken; a period of the 3rd fits no column.
    failed = "2024-01-01, 2024-01-03, 2024-01-04, 2024-01-05"
    assert run() == (0, 1, failed)
    assert run() == (0, 1, failed)
    kept = sorted((r.scope, r.dataset, r.file_key, r.reason) for r in ledger.open_rejects(spark, silver_root).collect())
    assert kept == [
        ("dates", "boxscores", "001", "an id is no integer"), ("dates", "boxscores", "002", "malformed"),
        ("dates", "fact_play_by_play", "404", "period: no int"), ("manifests", "manifests", "2024-01-05", "malformed")]
    assert names(st.scan_gold(gold, "fact_play_by_play").where("game_id = '404'"), "action_number") == [2]
    put(root, "boxscores", "002", box([player(6)], []))
    put(root, "pbp", "404", {"game": {"actions": [action(1), action(2)]}})
    put(root, "manifests", "2024-01-05", {"game_date": "2024-01-05", "game_ids": []})
    assert run() == (2, 2, "2024-01-04")
    assert {str(d) for d in names(ledger.done_in_ledger(spark, silver_root), "game_date")} == {"2024-01-01", "2024-01-03"}
    kept = [(r.dataset, r.file_key, r.row_pos) for r in ledger.open_rejects(spark, silver_root).collect()]
    assert kept == [("boxscores", "001", 2)]
    assert names(st.scan_gold(gold, "fact_play_by_play").where("game_id = '404'"), "action_number") == [1, 2]


def test_a_crash_after_silver_is_retried(spark, two_dates, tmp_path, monkeypatch):
    gold, silver_root = st.create_tables(spark, f"{tmp_path}/gold", 2), f"{tmp_path}/silver"
    run = lambda: jobs.backfill_lake(spark, str(two_dates), silver_root, gold, "2024-01-01", "2024-01-03")[0].first()
    with monkeypatch.context() as m:
        m.setattr("courtlake.plans.gold.load_fact", lambda *_a, **_b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert worklist.silver_dates(spark, silver_root).count() == 2
    assert run().processed == 2 and run().skipped == 2


def test_the_stream_keeps_what_it_cannot_read(spark, lake, tmp_path):
    import shutil

    root = shutil.copytree(lake, tmp_path / "raw")
    put(root, "manifests", "2024-01-09", '{"game_date"')
    gold, silver_root = st.create_tables(spark, f"{tmp_path}/gold", 2), f"{tmp_path}/silver"
    for _ in range(2):
        incremental_lake_run(spark, str(root), silver_root, gold, f"{tmp_path}/checkpoint")
    kept = sorted((r.dataset, r.file_key) for r in ledger.open_rejects(spark, silver_root).collect())
    assert kept == [("boxscores", "001"), ("boxscores", "002"), ("manifests", "2024-01-09")]
    states = {str(r.game_date): r.state for r in ledger.latest(spark, silver_root).where("scope = 'dates'").collect()}
    assert states == {"2024-01-01": "failed", "2024-01-03": "done"}


def test_counts_of_a_late_date(spark, two_dates, tmp_path):
    """Rows of later dates that are tried again are loaded, not counted; none twice."""
    manifests = documents.scan_manifests(spark, f"{two_dates}/manifests")
    gold, found = st.create_tables(spark, f"{tmp_path}/gold", 2), {}
    for day in ("2024-01-03", "2024-01-01"):
        _, counts = jobs.process_date(spark, manifests, jobs.lake_documents(str(two_dates)), f"{tmp_path}/silver", gold, day)
        found[day] = {r.table: (r.staged, r.loaded, r.dropped) for r in counts.collect()}
    assert found["2024-01-01"]["fact_shots"] == (4, 2, 2)
    assert found["2024-01-01"]["fact_player_stats"] == (4, 4, 0)


def test_team_files_left_out_are_kept(spark, lake, tmp_path):
    silver.build_dims_silver(spark, *silver.scan_dims(spark, str(lake)), f"{tmp_path}/s")
    kept = sorted((r.scope, r.file_key, r.reason) for r in ledger.open_rejects(spark, f"{tmp_path}/s").collect())
    assert kept == [("dimensions", "2", "a row does not fit"), ("dimensions", "3", "malformed")]


def test_rows_that_are_held_are_not_tried_again(spark, tmp_path, monkeypatch):
    root = tmp_path / "raw"
    for day, game, players, shot in (("2024-01-01", "001", [1, 3], [(10, 1)]), ("2024-01-03", "003", [1], [(20, 1), (21, 3)])):
        put(root, "manifests", day, {"game_date": day, "game_ids": [game]})
        put(root, "boxscores", game, box([player(p) for p in players], []))
        put(root, "shot_chart", game, shots(*shot))
    manifests = documents.scan_manifests(spark, f"{root}/manifests")
    store, again = st.create_tables(spark, f"{tmp_path}/gold", 2), {}
    load_fact = gold_plan.load_fact

    def seen(store, table, rows, rejects=None):
        if st.AGAIN in rows.columns:
            again[table] = {tuple(r) for r in rows.where(st.AGAIN).select(*st.GOLD[table].primary_key).collect()}
        return load_fact(store, table, rows, rejects)

    monkeypatch.setattr(gold_plan, "load_fact", seen)
    for day in ("2024-01-03", "2024-01-01"):
        jobs.process_date(spark, manifests, jobs.lake_documents(str(root)), f"{tmp_path}/silver", store, day)
    # Player 3 is known since the earlier date: only this shot of the later one had been left out.
    assert again["fact_shots"] == {("003", 21)}
    assert not again["fact_player_stats"]
    assert {r.game_event_id for r in st.scan_gold(store, "fact_shots").collect()} == {10, 20, 21}


def test_stubs_of_games_need_no_order(spark, tmp_path):
    """The earliest date of a game, no date before all others, without sorting the rows; and each stub once."""
    box_rows = spark.createDataFrame(
        [("g1", 5, "2020-01-02"), ("g1", 6, "2020-01-01"), ("g2", 5, None), ("g2", 7, "2020-01-03"), (None, 8, "2020-01-01")],
        "GAME_ID string, PERSON_ID bigint, game_date string",
    ).select("*", F.lit(1).cast("bigint").alias("TEAM_ID"), F.lit("f").alias("FIRST_NAME"), F.lit("l").alias("FAMILY_NAME"),
             F.lit("T").alias("TEAM_TRICODE"), F.lit(0).alias("_manifest_pos"), F.lit(0).alias("_row_pos"),
             ).withColumn("game_date", F.col("game_date").cast("date"))
    games = gold_plan.dimension_stubs(box_rows)["games"]
    found = {(r.game_id, r.season_id, str(r.game_date), str(r.since)) for r in games.collect()}
    assert found == {("g1", 2019, "2020-01-01", "2020-01-01"), ("g2", None, "None", "None")}
    assert "Window" not in games._jdf.queryExecution().executedPlan().toString()
    gold = st.create_tables(spark, str(tmp_path / "gold"), fact_buckets=2)
    st.append_absent(gold, "games", games, unique=True)
    st.append_absent(gold, "games", games, unique=True)
    assert sorted(r.game_id for r in st.scan_gold(gold, "games").collect()) == ["g1", "g2"]


def test_silver_rows_are_sorted_by_game_first(spark):
    """Nearly all rows differ in the game, so that few comparisons go on to the next column."""
    docs = documents.parse_documents(
        spark.createDataFrame([("g1", "{}")], "file_key string, doc string"), "doc", schemas.BOXSCORE_DOC)
    entries = spark.sql("SELECT DATE'2020-01-01' AS game_date, 0L AS manifest_pos, 'g1' AS game_id")
    built = silver.build_silver(entries, {"boxscores": documents.split_corrupt(docs)[0]})
    assert "Sort [GAME_ID" in built.rows["boxscores"]._jdf.queryExecution().executedPlan().toString()
