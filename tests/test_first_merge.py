"""Merges into buckets that hold nothing."""

from __future__ import annotations

from pathlib import Path

import pytest

from courtlake.operators import dedupe
from courtlake.operators import store as st
from courtlake.operators.upsert import upsert
from courtlake.session import shared_base


def plays(spark, rows):
    return spark.createDataFrame(rows, "game_id string, action_number bigint, period bigint")


def first_of(rows):
    return dedupe.keep_first(rows, ["game_id", "action_number"], ["period"])


def test_a_first_merge_joins_nothing_and_leaves_no_copy(spark, tmp_path):
    gold = st.create_tables(spark, f"{tmp_path}/gold", fact_buckets=2)
    st.append_absent(gold, "games", spark.createDataFrame([("a", 2020)], "game_id string, season_id int"))
    old = gold.snapshots("fact_play_by_play").scan().select("game_id", "action_number", "period")
    first = upsert(old, first_of(plays(spark, [("a", 1, 1)])), ["game_id", "action_number"], unique=True)
    plan = first._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    before = set(Path(shared_base(spark)).glob("courtlake/staged-*"))
    for period in (4, 2):
        source = plays(spark, [("a", 1, period), ("a", 1, period + 1), ("a", 2, 3), ("zz", 1, 1)])
        counts = st.merge_table(gold, "fact_play_by_play", source, reduce=first_of, unique=True).first()
        assert (counts.staged, counts.loaded, counts.dropped) == (4, 3, 1)
        found = st.scan_gold(gold, "fact_play_by_play").select("game_id", "action_number", "period")
        assert sorted(map(tuple, found.collect())) == [("a", 1, period), ("a", 2, 3)]
    assert set(Path(shared_base(spark)).glob("courtlake/staged-*")) == before


def test_a_null_key_fails_a_first_merge(spark, tmp_path):
    gold = st.create_tables(spark, f"{tmp_path}/gold", fact_buckets=2)
    st.append_absent(gold, "games", spark.createDataFrame([("a", 2020)], "game_id string, season_id int"))
    with pytest.raises(Exception, match=r"null in key \(game_id, action_number\) = \(a, null\)"):
        st.merge_table(gold, "fact_play_by_play", plays(spark, [("a", None, 1)]), reduce=first_of, unique=True)
    assert st.scan_gold(gold, "fact_play_by_play").isEmpty()
