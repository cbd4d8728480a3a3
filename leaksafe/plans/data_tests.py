"""The data tests of the relations: rules that share one scan per relation, and checks that need more than one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.operators import quality as q
from leaksafe.operators.horizons import BUCKETS
from leaksafe.operators.joins import validity_join
from leaksafe.operators.quality import Rule
from leaksafe.plans.staging import INJURY_LEVELS


def rules(t: Mapping[str, DataFrame]) -> list[Rule]:
    """Tests that one pass over a relation decides."""
    col = F.col
    completed = col("game_completed_flag") == 1
    spread = (col("market_type") == "spread") & (col("selection") == "home")
    total = (col("market_type") == "total") & (col("selection") == "over")
    teams = lambda side: lambda: t["stg_teams"].select(col("team_abbr").alias(f"{side}_team"))
    unknown = lambda c, values: ~col(c).isin(list(values))
    return [
        Rule("raw_pbp", "plays_unique", unique=("game_id", "play_id")),
        Rule("stg_games", "games_unique", unique=("game_id",)),
        Rule("stg_games", "games_not_null", q.any_null("game_id")),
        Rule("stg_games", "scores_in_range", q.outside("home_score", 0, 80) | q.outside("away_score", 0, 80), where=completed),
        Rule("stg_games", "completed_games_have_scores", q.any_null("home_score", "away_score"), where=completed),
        Rule("stg_games", "home_team_known", parent=teams("home"), on=("home_team",)),
        Rule("stg_games", "away_team_known", parent=teams("away"), on=("away_team",)),
        Rule("stg_player_week", "player_week_not_null", q.any_null("player_id")),
        Rule("stg_player_week", "player_week_unique", unique=("season", "week", "player_id", "position")),
        Rule("stg_player_week", "points_not_too_low", q.outside("fantasy_points_ppr", -20)),
        Rule("int_team_form", "no_form_in_first_week", q.outside("games_played_std", None, 0), where=col("week") == 1),
        Rule("int_team_game", "team_game_unique", unique=("game_id", "team")),
        Rule("stg_injuries_weekly", "severity_values", unknown("injury_severity_score", [0, *sorted(INJURY_LEVELS.values())])),
        Rule("int_injury_team_impact", "injury_impact_unique", unique=("team", "season", "week")),
        Rule("int_market_time_buckets", "bucket_labels", unknown("time_bucket", [b for b, _ in BUCKETS])),
        Rule("int_market_time_buckets", "snapshots_before_kickoff", q.outside("hours_before_kickoff", 0)),
        Rule("stg_market_game_line", "market_types", unknown("market_type", q.ODDS.accepted["market_type"])),
        Rule("stg_market_game_line", "probability_in_range", q.outside("implied_prob_raw", 0, 1)),
        Rule("int_market_open_close", "opening_spread_in_range", q.outside("opening_line", -30, 30), where=spread),
        Rule("int_market_open_close", "opening_total_in_range", q.outside("opening_line", 25, 80), where=total),
        Rule("stg_weather_game_hourly", "wind_not_negative", q.outside("wind_mph", 0)),
        Rule("stg_weather_game_hourly", "temperature_in_range", q.outside("temp_f", -50, 130)),
        Rule("stg_weather_game_hourly", "forecast_has_run", q.any_null("forecast_run_ts"), where=col("weather_type") == "forecast"),
        Rule("int_weather_game", "closed_roof_scores_zero", q.fails(col("adverse_weather_score") <= 0), where=col("roof_closed_flag") == 1),
        Rule("int_team_travel_game", "travel_not_negative", q.outside("travel_km", 0)),
        Rule("int_team_travel_game", "home_team_does_not_travel", q.outside("travel_km", None, 1), where=col("is_away_team") == 0),
        Rule("int_team_power_rating", "rating_in_range", q.outside("elo_rating_pregame", 1000, 2000)),
        Rule("int_team_power_rating", "rating_unique", unique=("game_id", "team")),
    ]


def checks(t: Mapping[str, DataFrame]) -> dict:
    """Tests that join or group a relation anew, or look at columns alone: each returns its failing rows."""
    col = F.col

    def stadium_missing():
        s = t["stg_stadium"].select(col("team").alias("home_team"), "season_start", "season_end", "stadium_id")
        games = t["stg_games"].filter("game_completed_flag = 1 AND location != 'Neutral'").drop("stadium_id")
        return validity_join(games, s, "home_team", "season").filter(col("stadium_id").isNull())

    def forecast_after_kickoff():
        used = t["int_weather_game"].filter("weather_source_type = 'forecast'").select("game_id", "forecast_run_ts")
        kick = t["stg_weather_game_kickoff"].select("game_id", "kickoff_ts_approx")
        return q.before_event(used, kick, ["game_id"], "forecast_run_ts", "kickoff_ts_approx")

    return {
        "season_in_range": lambda: q.group_range(t["raw_pbp"], ["season"], F.first("season"), 1999, 2030),
        "backtest_has_no_close": lambda: t["mart_backtest_game"].limit(1).filter(
            F.lit("closing_spread" in t["mart_backtest_game"].columns)
        ),
        "backtest_has_weather_source": lambda: q.has_columns(t["mart_backtest_game"], ["weather_source_type"]),
        "stadium_known": stadium_missing,
        "forecast_before_kickoff": forecast_after_kickoff,
    }


def run_all(spark: SparkSession, t: Mapping[str, DataFrame]) -> DataFrame:
    return q.run_rules(spark, t, rules(t)).unionByName(q.run(spark, checks(t)))


def market_coverage(t: dict[str, DataFrame], last: int = 5) -> DataFrame:
    """Games with an opening and a closing spread, for the latest seasons."""
    rows = t["int_market_open_close"].filter("market_type = 'spread' AND selection = 'home'")
    out = q.coverage(
        rows, ["season"], "game_id",
        {"games_with_opening_spread": F.col("opening_line").isNotNull(), "games_with_closing_spread": F.col("closing_line").isNotNull()},
    )
    return out.withColumnRenamed("total_keys", "games_with_odds").orderBy(F.col("season").desc()).limit(last)


def weather_coverage(t: dict[str, DataFrame], last: int = 5) -> DataFrame:
    out = q.coverage(
        t["stg_weather_game_kickoff"], ["season"], "game_id",
        {
            "games_with_weather": F.col("temp_f").isNotNull(),
            "games_with_forecast": F.col("weather_source_type") == "forecast",
            "games_with_historical": F.col("weather_source_type") == "historical",
        },
    )
    return out.withColumnRenamed("total_keys", "games_total").orderBy(F.col("season").desc()).limit(last)
