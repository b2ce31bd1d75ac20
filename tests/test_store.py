"""Stored gold tables: counts, idempotence, untouched buckets, readers and crashes at every step."""

from __future__ import annotations

from pathlib import Path

import pytest

from courtlake.operators import snapshots
from courtlake.operators import store as st


@pytest.fixture()
def gold(spark, tmp_path):
    return st.create_tables(spark, str(tmp_path / "gold"), fact_buckets=8)


def games(spark, ids, season=2023):
    return spark.createDataFrame([(i, season, None) for i in ids],
                                 "game_id string, season_id int, game_date date")


def plays(spark, rows):
    return spark.createDataFrame(rows, "game_id string, action_number bigint, period bigint")


def content(gold, table, *columns):
    return sorted(tuple(r) for r in st.scan_gold(gold, table).select(*columns).collect())


def files(gold, table):
    return set(Path(gold.path(table)).glob("data/*/*/*.parquet"))


def test_merge_filters_counts_and_repeats(spark, gold):
    st.append_absent(gold, "games", games(spark, ["a", "b"]))
    source = plays(spark, [("a", 1, 1), ("b", 1, 2), ("zz", 1, 3)])
    for _ in range(2):
        counts = st.merge_table(gold, "fact_play_by_play", source).first()
        assert (counts.staged, counts.loaded, counts.dropped) == (3, 2, 1)
        assert content(gold, "fact_play_by_play", "game_id", "period") == [("a", 1), ("b", 2)]


def test_empty_source_writes_nothing(spark, gold):
    counts = st.merge_table(gold, "fact_play_by_play", plays(spark, [])).first()
    assert (counts.staged, counts.loaded) == (0, 0)
    assert content(gold, "fact_play_by_play", "game_id") == []
    st.append_absent(gold, "games", games(spark, []))
    assert gold.snapshots("games").versions() == gold.snapshots("fact_play_by_play").versions() == [0]


def test_only_touched_buckets_are_rewritten(spark, gold):
    ids = [f"g{i}" for i in range(40)]
    st.append_absent(gold, "games", games(spark, ids))
    st.merge_table(gold, "fact_play_by_play", plays(spark, [(i, 1, 1) for i in ids]))
    table = gold.snapshots("fact_play_by_play")
    before = table.current()
    st.merge_table(gold, "fact_play_by_play", plays(spark, [("g0", 1, 9)]))
    after = table.current()
    changed = [b for b in after.parts if after.parts[b] != before.parts[b]]
    assert after.version == before.version + 1 and len(changed) == 1 and len(after.parts) > 4
    assert len(content(gold, "fact_play_by_play", "game_id")) == 40
    assert ("g0", 9) in content(gold, "fact_play_by_play", "game_id", "period")
    assert {f.split("/")[-2] for f in table.scan(changed).inputFiles()} == {f"_bucket={changed[0]}"}


def test_existing_rows_survive_inserts_and_creation(spark, gold):
    st.append_absent(gold, "games", games(spark, ["a"], 1999))
    st.append_absent(gold, "games", games(spark, ["a", "b"], 2000))
    again = st.create_tables(spark, gold.root, fact_buckets=99)
    assert again.fact_buckets == 8
    assert content(again, "games", "game_id", "season_id") == [("a", 1999), ("b", 2000)]


STEPS = ["_write", "put_text", "sweep", "remove"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_commit_cut_off_at_any_step(spark, gold, monkeypatch, step, when):
    """The old table stands until the pointer is there, then the new one; the next merge goes on from it."""
    ids = [f"g{i}" for i in range(12)]
    st.append_absent(gold, "games", games(spark, ids))
    for period in range(2 if step == "remove" else 4, 5):  # removal needs versions that are no longer kept
        st.merge_table(gold, "fact_play_by_play", plays(spark, [(i, 1, period) for i in ids]))
    old = [(i, 4) for i in sorted(ids)]
    new = [(i, 5) for i in sorted(ids)]
    committed = {"_write": False, "put_text": when == "after", "sweep": True, "remove": True}[step]
    holder = snapshots.SnapshotTable if step in ("_write", "sweep") else snapshots
    plain = getattr(holder, step)

    def lost(*args, **more):
        if when == "after":
            plain(*args, **more)
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(holder, step, lost)
        with pytest.raises(OSError, match="driver lost"):
            st.merge_table(gold, "fact_play_by_play", plays(spark, [(i, 1, 5) for i in ids]))
    reopened = st.create_tables(spark, gold.root)
    assert content(reopened, "fact_play_by_play", "game_id", "period") == (new if committed else old)
    st.merge_table(reopened, "fact_play_by_play", plays(spark, [("g0", 1, 6)]))
    expected = sorted([("g0", 6), *(r for r in (new if committed else old) if r[0] != "g0")])
    assert content(reopened, "fact_play_by_play", "game_id", "period") == expected
    named = {(v, b) for k in reopened.snapshots("fact_play_by_play").versions()
             for b, versions in reopened.snapshots("fact_play_by_play").at(k).parts.items() for v in versions}
    stored = {(int(p.parent.parent.name[9:]), int(p.parent.name[8:])) for p in files(gold, "fact_play_by_play")}
    assert stored == named


def test_a_reader_keeps_what_it_started_on(spark, gold, monkeypatch):
    """Between any two steps of a commit the table is whole, and earlier reads stay valid."""
    ids = [f"g{i}" for i in range(30)]
    st.append_absent(gold, "games", games(spark, ids))
    st.merge_table(gold, "fact_play_by_play", plays(spark, [(i, 1, 1) for i in ids]))
    early = st.scan_gold(gold, "fact_play_by_play").select("period")
    seen = []

    def watched(name, holder):
        plain = getattr(holder, name)

        def run(*args, **more):
            seen.append({r[0] for r in content(gold, "fact_play_by_play", "period")})
            found = plain(*args, **more)
            seen.append({r[0] for r in content(gold, "fact_play_by_play", "period")})
            return found

        monkeypatch.setattr(holder, name, run)

    for name, holder in (("_write", snapshots.SnapshotTable), ("put_text", snapshots), ("sweep", snapshots.SnapshotTable)):
        watched(name, holder)
    st.merge_table(gold, "fact_play_by_play", plays(spark, [(i, 1, 2) for i in ids]))
    assert seen == [{1}, {1}, {1}, {2}, {2}, {2}]
    assert {r[0] for r in early.collect()} == {1} and early.count() == 30


def test_a_second_writer_fails(spark, gold):
    table = gold.snapshots("games")
    rows = games(spark, ["a"]).withColumn(st.AS_OF, st.F.lit(None).cast("date"))
    placed = st._placed(gold, "games", rows)
    table.append(placed)
    with pytest.raises(FileExistsError):
        table._commit(1, {})
    assert content(gold, "games", "game_id") == [("a",)]
    with pytest.raises(ValueError, match="outside"):
        table.replace(placed, [7])
    assert content(gold, "games", "game_id") == [("a",)]


def test_many_appends_leave_few_files(spark, gold):
    for i in range(20):
        st.append_absent(gold, "games", games(spark, [f"g{i:02d}", "g00"]))
    assert content(gold, "games", "game_id") == [(f"g{i:02d}",) for i in range(20)]
    assert len(gold.snapshots("games").current().parts[0]) <= snapshots.FULL
    assert len(files(gold, "games")) <= 2 * snapshots.FULL + snapshots.KEPT
    assert len(gold.snapshots("games").versions()) == snapshots.KEPT


def test_rows_that_do_not_fit_are_left_out_or_fail(spark, gold):
    st.append_absent(gold, "games", games(spark, ["a", "b"]))
    source = plays(spark, [("a", 1, 1), ("b", 1, 1 << 40), ("b", 2, None)])
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        st.merge_table(gold, "fact_play_by_play", source)
    rejects = []
    counts = st.merge_table(gold, "fact_play_by_play", source, rejects=rejects).first()
    assert (counts.staged, counts.loaded, counts.dropped) == (3, 2, 1)
    assert content(gold, "fact_play_by_play", "game_id", "action_number") == [("a", 1), ("b", 2)]
    bad, = rejects[0].select("game_id", "_reason", "_raw").collect()
    assert bad._reason == "period: no int" and '"period":1099511627776' in bad._raw and bad.game_id == "b"


def rows_read(df):
    """Rows that the scan of a plan without shuffles hands on, after row groups were left out."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_bloom_filters_leave_out_row_groups(spark, gold):
    # Every second id of a range, too many different ones for a dictionary of the column.
    ids = spark.range(0, 400_000, 2).selectExpr(
        "format_string('%032d', id) AS game_id", "2023 AS season_id", "date '2024-01-01' AS game_date")
    st.append_absent(gold, "games", ids)
    absent, held = f"{100_001:032d}", f"{100_000:032d}"
    assert rows_read(st.scan_gold(gold, "games").where(f"game_id = '{held}'")) > 0
    assert rows_read(st.scan_gold(gold, "games").where(f"game_id = '{absent}'")) == 0
