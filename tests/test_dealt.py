"""Shared relations dealt by a key: what reads them exchanges their wide rows no more."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF
from leaksafe.operators.marts import Join, assemble
from leaksafe.plans import relations as plans
from leaksafe.plans.derived import LINES_PLACED, needs, raw_frame
from leaksafe.plans.relations import CATALOG, PARTITIONS, partitions_for, relations, staying
from leaksafe.sources.tables import write_dealt


@pytest.fixture(scope="module")
def built(spark):
    return relations(spark, SF)


def exchanges(spark, build) -> int:
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        with staying(spark, True):
            return build()._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set(threshold, before)


def test_dealt_rows_come_back_whole_and_group_in_place(spark, frame, tmp_path):
    rows = frame("k string, v int", *[(f"k{i % 5}", i) for i in range(40)], (None, 1), (None, None))
    back = write_dealt(rows.repartition(8, "k"), str(tmp_path / "t"), ["k"])
    assert back.columns == rows.columns and back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    assert exchanges(spark, lambda: back.groupBy("k").agg(F.sum("v"))) == 0


@pytest.mark.parametrize(
    ("name", "most"),
    # Markets are picked in place; the kickoffs come to their lines; plays are rolled up in place; a team's form is dealt once.
    [("stg_market_close_game", 0), ("stg_market_consensus_game", 0), ("int_market_open_close", 0), ("int_market_time_buckets", 1), ("int_team_game", 0)],
)
def test_relations_of_a_game_find_it_in_one_place(spark, built, name, most):
    relation = CATALOG.relations[name]
    assert exchanges(spark, lambda: relation.build(*[built[n] for n in relation.needs])) <= most


def test_odds_are_grouped_where_the_lines_are(spark, built):
    assert exchanges(spark, lambda: built["raw_market_odds_snapshot"]) == 0


def test_wide_base_stays_and_rows_are_those_of_plain_joins(frame, rows):
    base = frame("g string, h int, a int, w int", ("x", 1, 2, 1), ("y", 3, 1, 1), ("y", 3, 1, 1), (None, 1, 2, 1), ("z", None, 9, 2), (None, None, None, None))
    teams = frame("t int, w int, v double", (1, 1, 0.5), (2, 1, 1.5), (2, 1, 2.5), (3, 1, 3.5), (None, 1, 4.5))
    games = frame("g string, m int", ("x", 7), ("y", 8), (None, 9))
    joins = [
        Join(teams, {"h": "t", "w": "w"}, {"h_v": "v"}), Join(games, {"g": "g"}, {"m": "m"}), Join(teams, {"a": "t", "w": "w"}, {"a_v": "v"}),
    ]
    want, got = assemble(base, joins), assemble(base, joins, at=["g"])
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert sorted(rows(got), key=str) == sorted(rows(want), key=str) and want.count() == 8


def test_shuffles_have_as_many_partitions_as_the_tables_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plans, "ROWS_PER_TASK", 4)
    before = spark.conf.get(PARTITIONS)
    try:
        for rows in (50, 500):
            folder = f"{tmp_path}/{rows}"
            spark.range(rows).write.parquet(f"{folder}/lineitem.parquet")
            spark.range(2).write.parquet(f"{folder}/orders.parquet")
            want = -(-(rows + 2) // 4)
            assert partitions_for(spark, folder) == want == relations(spark, folder).partitions
            assert int(spark.conf.get(PARTITIONS)) == want
            # The setting is raised, never lowered, and holds for each call.
            spark.conf.set(PARTITIONS, "1000")
            relations(spark, folder)
            assert spark.conf.get(PARTITIONS) == "1000"
            spark.conf.set(PARTITIONS, before)
            relations(spark, folder)
            assert int(spark.conf.get(PARTITIONS)) == want
            spark.conf.set(PARTITIONS, before)
    finally:
        spark.conf.set(PARTITIONS, before)


def test_player_weeks_are_grouped_where_the_lines_are(spark, built):
    assert exchanges(spark, lambda: raw_frame(spark, SF, "player_weeks", built.__getitem__)) == 0


def test_lines_carry_no_derived_columns_through_the_exchange(spark, built):
    dealt = spark.sql(LINES_PLACED, **{n: built[n] for n in needs(LINES_PLACED)})
    assert not {"game_id", "home_no", "away_no", "other_no"} & set(dealt.columns)
    assert raw_frame(spark, SF, "lines", built.__getitem__).exceptAll(built["lines"]).isEmpty()
