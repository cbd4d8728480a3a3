"""Relations over derived data, models, and the driver contract."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from conftest import SF
from leaksafe.functions import geo
from leaksafe.operators import marts, ml, quality
from leaksafe.plans import data_tests, dimensions
from leaksafe.plans.queries_relations import _Frames
from leaksafe.plans.registry import QUERIES
from leaksafe.plans.relations import CATALOG, relations
from leaksafe.plans.staging import weather_at_kickoff


def test_rules_of_a_relation_share_its_scan(built):
    frames = _Frames(built)
    tables = dict.fromkeys(r.table for r in data_tests.rules(frames))
    for name in tables:
        rules = [r for r in data_tests.rules(frames) if r.table == name]
        out = quality.run_rules(frames[name].sparkSession, frames, rules)
        reads = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
        unique = sum(bool(r.unique) for r in rules)
        parents = sum(reads(r.parent()) for r in rules if r.parent is not None)
        assert reads(out) == max(1, unique) * reads(frames[name]) + parents


def test_pair_distances(frame):
    places = frame("season int, team string, latitude double, longitude double, timezone string", (2023, "NY", 40.7, -74.0, "America/New_York"), (2023, "LA", 34.0, -118.2, "America/Los_Angeles"), (2024, "NY", 40.7, -74.0, "America/New_York"))
    games = frame("season int, home_team string, away_team string", (2023, "NY", "LA"), (2023, "NY", "LA"), (2024, "NY", "LA"))
    out = {(r["season"], r["home_team"], r["away_team"]): r for r in geo.pair_distances(games, places).collect()}
    assert set(out) == {(2023, "NY", "LA"), (2024, "NY", "LA")}
    trip = out[2023, "NY", "LA"]  # away LA travels east
    assert 3900 < trip["travel_km"] < 4000 and trip["timezone_shift_hours"] == 3.0
    assert (trip["west_to_east_flag"], trip["east_to_west_flag"], trip["international_travel_flag"]) == (1, 0, 0)
    assert out[2024, "NY", "LA"]["travel_km"] is None


@pytest.fixture(scope="module")
def built(spark):
    return relations(spark, SF)


def test_every_relation_has_its_grain(spark, built):
    checks = {
        name: (lambda n=name, k=r.key: quality.unique(built[n], list(k)))
        for name, r in CATALOG.relations.items()
        if r.key and name.startswith(("int_", "mart_"))
    }
    assert len(checks) >= 26
    quality.stop_on_failure(quality.run(spark, checks))


def test_marts_keep_the_number_of_games(built):
    games = built["int_game_base"].count()
    for name in ("mart_game_modeling_base", "mart_spread_modeling", "mart_total_modeling", "mart_game_modeling"):
        assert built[name].count() == games


def test_data_tests_find_only_what_the_data_holds(spark, built):
    out = data_tests.run_all(spark, _Frames(built)).collect()
    assert len(out) == 33
    status = {r["check_name"]: r["status"] for r in out}
    assert "ERROR" not in status.values()
    # Some customers have no stadium, by construction.
    assert {n for n, s in status.items() if s == "FAIL"} <= {"stadium_known", "plays_unique"}


def test_backtest_is_leakage_safe(built):
    mart = built["mart_game_modeling"]
    with pytest.raises(ValueError, match="closing_spread"):
        quality.assert_leakage_safe(mart, 1)
    # Realized weather is not known before the game, whatever mart carries it.
    for name in ("mart_backtest_game", "mart_game_modeling_no_market"):
        with pytest.raises(ValueError, match="eff_temp_f"):
            quality.assert_leakage_safe(built[name], 1)
        left = marts.drop_zone(built[name], 3)
        quality.assert_leakage_safe(left, 1)
        assert "eff_temp_f" not in left.columns and "home_games_played" in left.columns


def test_seeds(spark, built):
    assert built["dim_position_group"].count() == 22 == len(dimensions.POSITIONS)
    assert built["dim_sportsbook"].count() == 9
    assert built["dim_market_type"].count() == 5
    assert built["stg_external_odds_game"].count() == 0
    assert len(dimensions.DIMENSIONS.relations) == 28


def test_forecast_mode_uses_runs_before_the_cutoff(built):
    out = weather_at_kickoff(built["stg_games"], built["raw_stadium_metadata"], built["stg_weather_game_hourly"], forecast_hours=24)
    late = F.col("forecast_run_ts") >= F.col("kickoff_ts_approx") - F.expr("INTERVAL 24 HOURS")
    assert out.filter(late).count() == 0
    assert out.filter(F.col("weather_source_type") == "forecast").count() > 0
    assert out.count() == built["stg_games"].count()


def test_venue_zone_moves_the_kickoff(spark, frame):
    games = frame("game_id string, season int, week int, game_date date, home_team string, kickoff_time_local string, roof string, stadium_id string", ("g", 2024, 1, dt.date(2024, 9, 8), "KC", "13:00", "OPEN", "x"))
    stadiums = frame("stadium_id string, team string, season_start int, season_end int, roof_type string, timezone string", ("S", "KC", 2000, 9999, "open", "America/Chicago"))
    hourly = frame(
        "stadium_id string, game_date date, weather_ts timestamp, weather_type string, forecast_run_ts timestamp, weather_code int, weather_condition string, wind_dir_deg int, "
        + ", ".join(f"{c} double" for c in "temp_f apparent_temp_f precip_in rain_in snow_in snow_depth_in wind_mph wind_gusts_mph humidity_pct dew_point_f pressure_hpa".split()),
        *[("S", dt.date(2024, 9, 8), dt.datetime(2024, 9, 8, h), "historical", None, 0, "Clear", 0, float(h), *[0.0] * 10) for h in (13, 18)],
    )
    assert weather_at_kickoff(games, stadiums, hourly).first()["temp_f"] == 13.0
    assert weather_at_kickoff(games, stadiums, hourly, zone_mode="venue").first()["temp_f"] == 18.0


def test_model_run(spark, built, tmp_path):
    mart = built["mart_backtest_game_base"].withColumns(
        {"opening_spread": F.col("spread_line_nflverse"), "opening_total": F.col("total_line_nflverse"), "opening_home_win_prob": F.lit(0.5)}
    )
    mart = mart.withColumn("cv_split", F.when(F.col("season") < 2018, "train").when(F.col("season") < 2020, "validation").otherwise("test"))
    mart = mart.withColumn("id", F.xxhash64("game_id"))
    models, reports, predictions = ml.run(mart, mart.limit(5), id="id", max_iter=3)
    assert set(models) == {"margin", "total", "win_prob"}
    assert reports["accuracy_spread"].first()["n"] > 0 and reports["by_period"].count() >= 1
    scored = predictions.collect()
    assert len(scored) == 5 and all(0 <= r["pred_win_prob"] <= 1 for r in scored)
    assert all(r["win_prob_edge"] is not None for r in scored)
    ml.save(models, str(tmp_path / "m"), seasons="2015-2021")
    again = ml.load(spark, str(tmp_path / "m"))
    rows = ml.engineer(mart).limit(3)
    one, two = (sorted(r["pred_margin"] for r in ml.score(rows, m).collect()) for m in (models, again))
    assert one == two and len(models["margin"].importance()) == len(models["margin"].features)


def test_driver_contract(spark):
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries)
    assert set(QUERIES) <= set(queries)
    assert set(QUERIES) - set(oracle) <= {"gbt_scores"}
    assert contract.entry(spark).count() > 0


SAMPLE = (
    "lagged_form", "event_rollup", "horizon_buckets", "nearest_join", "latest_before_cutoff", "affine_rating", "scenario_summary",
    "quality_report", "stream_latest", "int_team_form", "mart_game_modeling",
)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    import duckdb

    import check

    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = check.normalise(contract.queries()[name](spark, SF).toPandas())
    want = check.normalise(con.execute(contract.oracle_sql()[name]).fetchdf())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_a_wrong_pair_in_the_code_shows(spark, monkeypatch):
    """The SQL has column maps of its own: two entries that change places in the code's map are a difference."""
    import duckdb

    import check
    from leaksafe.plans import intermediate
    from leaksafe.plans.queries_relations import comparable
    from leaksafe.plans.relations import Relations

    swapped = {**intermediate.FORM_STD, "pts_for_std": "points_against", "pts_against_std": "points_for"}
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = check.normalise(con.execute(contract.oracle_sql()["int_team_form"]).fetchdf())
    form = lambda: check.normalise(comparable(Relations(spark, SF)["int_team_form"]).toPandas())
    assert form().equals(want)
    monkeypatch.setattr(intermediate, "FORM_STD", swapped)
    assert not form().equals(want)


def test_forecasts_are_known_at_their_horizon(built):
    """Every run was made before the horizon; the backtest with forecasts has no column that is never known."""
    kick = built["stg_weather_game_kickoff"].select("game_id", "kickoff_ts_approx")
    rows = built["int_weather_horizon"].join(kick, "game_id")
    known = rows.filter(F.col("forecast_run_ts").isNotNull())
    assert known.count() > 0
    late = F.col("forecast_run_ts") >= F.timestamp_add("HOUR", -F.col("hours_before_event"), F.col("kickoff_ts_approx"))
    assert known.filter(late).count() == 0
    mart = built["mart_backtest_game_forecast"]
    weather = [c for c in mart.columns if c.startswith("eff_") or c in ("wind_bucket", "adverse_weather_score", "passing_condition_score")]
    assert len(weather) == 6 and all(quality.zone_of(mart, c) < 3 for c in weather)
    assert any(quality.zone_of(built["mart_backtest_game"], c) == 3 for c in weather)


def test_odds_are_read_off_the_lines_once(spark, built):
    from leaksafe.plans import derived

    stated = spark.sql(derived.SQL["raw_market_odds_snapshot"], lines=built["lines"], held=built["held"])
    odds = built["raw_market_odds_snapshot"]
    assert odds.dtypes == stated.dtypes and odds.count() > 0
    assert odds.exceptAll(stated).isEmpty() and stated.exceptAll(odds).isEmpty()
    assert odds._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_shared_relations_are_written_without_an_exchange(built, monkeypatch):
    from leaksafe.plans import relations as module

    plans = []
    write = module.write_table

    def watched(df, path, **settings):
        plans.append((df, settings))
        return write(df, path, **settings)

    monkeypatch.setattr(module, "write_table", watched)
    fresh = module.Relations(built.spark, built.folder)
    assert fresh["stg_weather_game_kickoff"].exceptAll(built["stg_weather_game_kickoff"]).isEmpty()
    assert plans and all("partition" not in settings for _, settings in plans)


def test_filled_keys_exchange_only_rows_without_one(frame):
    from leaksafe.operators import joins

    rows = frame("k string, a int, v int", ("x", 1, 1), (None, 1, 2), (None, 2, 3), (None, None, 4), ("y", None, 5))
    lookup = frame("k string, a int", ("n", 1), ("m", 1), (None, 2))
    out = joins.fill_key(rows, lookup, ["a"], "k")
    assert sorted((r["v"], r["k"]) for r in out.select("v", "k").collect() if r["k"]) == [(1, "x"), (2, "m"), (5, "y")]
    assert out.count() == 5 and set(out.columns) == {"k", "a", "v"}
    joined = out._jdf.queryExecution().optimizedPlan().toString().split("Join ", 1)[1]
    assert "isnull(k" in joined


def test_wide_player_rows_are_exchanged_once_for_both_joins(built):
    from leaksafe.plans.relations import staying

    spark, threshold = built.spark, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    relation = CATALOG.relations["int_player_game"]
    spark.conf.set(threshold, "-1")
    try:
        with staying(spark, relation.stay):
            plan = relation.build(*[built[n] for n in relation.needs])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    between = plan.split("SortMergeJoin")[1]  # from the join with the snap counts down to the one with the games
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in between
