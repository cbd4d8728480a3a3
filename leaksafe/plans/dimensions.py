"""Dimension and fact tables: typed projections of relations on a declared key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.operators import clean, quality
from leaksafe.operators.facts import upsert
from leaksafe.plans.catalog import Catalog, Relation

DIMENSIONS = Catalog()

# Position, group, side of the ball.
POSITIONS = [
    ("QB", "QB", "offense"), ("RB", "RB", "offense"), ("HB", "RB", "offense"), ("FB", "RB", "offense"),
    ("WR", "WR", "offense"), ("TE", "TE", "offense"), ("C", "OL", "offense"), ("G", "OL", "offense"), ("T", "OL", "offense"),
    ("DE", "DL", "defense"), ("DT", "DL", "defense"), ("NT", "DL", "defense"), ("ILB", "LB", "defense"),
    ("OLB", "LB", "defense"), ("MLB", "LB", "defense"), ("CB", "CB", "defense"), ("FS", "S", "defense"),
    ("SS", "S", "defense"), ("DB", "S", "defense"), ("K", "K", "special_teams"), ("P", "P", "special_teams"),
    ("LS", "LS", "special_teams"),
]
# Sportsbook key, name, sharp, consensus, legal in the US, country, notes.
SPORTSBOOKS = [
    ("pinnacle", "Pinnacle Sports", 1, 0, 0, "Curacao", "Sharp book, highest limits"),
    ("draftkings", "DraftKings", 0, 0, 1, "US", ""),
    ("fanduel", "FanDuel", 0, 0, 1, "US", ""),
    ("betmgm", "BetMGM", 0, 0, 1, "US", ""),
    ("caesars", "Caesars Sportsbook", 0, 0, 1, "US", ""),
    ("bet365", "Bet365", 0, 0, 0, "UK", ""),
    ("espn_consensus", "ESPN/nflverse Consensus", 0, 1, 1, "US", "nflverse source"),
    ("pinnacle_consensus", "SBR/Pinnacle Consensus", 1, 1, 0, "Multi", "SBR CSV source"),
    ("consensus", "Market Consensus", 0, 1, 1, "Multi", "Aggregated"),
]
# Market key, description, category, two-sided.
MARKET_TYPES = [
    ("spread", "Point Spread", "game_line", 1),
    ("total", "Game Total (O/U)", "game_line", 1),
    ("moneyline", "Moneyline (H2H)", "game_line", 1),
    ("team_total", "Team Total", "derivative", 1),
    ("player_prop", "Player Proposition", "player_prop", 0),
]


def seed(spark, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _columns(text: str) -> dict:
    """'name type, source>name type, …' as a projection; a name without source keeps its own."""
    spec = {}
    for part in text.split(","):
        name, dtype = part.split()
        source, _, out = name.partition(">")
        spec[out or source] = (source, dtype)
    return spec


# Tables that project one relation: name → (relation, {output: (column, type)}).
PROJECTED: dict[str, tuple[str, dict]] = {}


def table(name: str, source: str, key: str, columns: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Declare a table as a typed projection of one relation."""
    spec = _columns(columns)
    PROJECTED[name] = (source, spec)

    def build(df: DataFrame) -> DataFrame:
        return clean.project(prepare(df) if prepare else df, spec)

    DIMENSIONS.relations[name] = Relation(name, (source,), build, key=tuple(key.split()))


@DIMENSIONS.relation("stg_games", key=("season",))
def dim_season(games: DataFrame) -> DataFrame:
    post = F.col("season_type") == "postseason"
    return games.groupBy("season").agg(
        F.when(F.max(post), "postseason").otherwise("regular").alias("season_type"),
        F.first("season").alias("league_year"),
        F.min("game_date").alias("season_start_date"),
        F.max("game_date").alias("season_end_date"),
        F.min(F.when(post, F.col("week"))).alias("playoffs_start_week"),
        F.max(F.when(F.col("game_type") == "SB", F.col("week"))).alias("super_bowl_week"),
    )


@DIMENSIONS.relation("stg_games", key=("season", "week"))
def dim_week(games: DataFrame) -> DataFrame:
    return games.groupBy("season", "week").agg(
        F.max("season_type").alias("season_type"), F.min("game_date").alias("week_start_date"), F.max("game_date").alias("week_end_date")
    )


@DIMENSIONS.relation("stg_teams", key=("team_abbr",))
def dim_team(teams: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return teams.select(
        "team_abbr", F.col("team_name").alias("full_name"), none.alias("short_name"), F.col("team_conf").alias("conference"),
        F.col("team_division").alias("division"), none.alias("team_color"), none.alias("team_color2"), none.alias("team_logo_url"),
        F.col("team_abbr").alias("current_abbr"), F.lit(1).alias("active_flag"),
    )


@DIMENSIONS.relation("stg_players", key=("player_id",))
def dim_player(players: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    kept = "full_name first_name last_name position position_group birth_date college height weight entry_year rookie_year draft_club draft_number"
    return players.select(
        "player_id", *kept.split(), F.coalesce("active_flag", F.lit(1)).alias("active_flag"), "headshot_url",
        none.alias("pfr_id"), none.alias("espn_id"), none.alias("sleeper_id"),
    )


@DIMENSIONS.relation("stg_games", key=("position",))
def dim_position_group(games: DataFrame) -> DataFrame:
    return seed(games.sparkSession, POSITIONS, "position string, position_group string, side_of_ball string")


@DIMENSIONS.relation("stg_games", key=("sportsbook_key",))
def dim_sportsbook(games: DataFrame) -> DataFrame:
    schema = (
        "sportsbook_key string, sportsbook_name string, is_sharp int, is_consensus int, is_us_legal int, country string, notes string"
    )
    return seed(games.sparkSession, SPORTSBOOKS, schema)


@DIMENSIONS.relation("stg_games", key=("market_type_key",))
def dim_market_type(games: DataFrame) -> DataFrame:
    schema = "market_type_key string, market_description string, market_category string, two_sided int"
    return seed(games.sparkSession, MARKET_TYPES, schema)


table(
    "dim_game", "stg_games", "game_id",
    "game_id string, season int, week int, season_type string, game_date date, kickoff_time_local>kickoff_time string, "
    "home_team string, away_team string, stadium string, surface string, roof string",
)
table(
    "fact_play", "stg_plays", "game_id play_id",
    "game_id string, play_id int, season int, week int, posteam string, defteam string, play_type string, down int, ydstogo int, "
    "yardline_100 int, yards_gained double, epa double, wpa double, success int, pass_attempt int, rush_attempt int, "
    "touchdown int, interception int, fumble_lost int, sack int, air_yards double, yards_after_catch double, passer_id string, "
    "rusher_id string, receiver_id string, score_differential double, game_seconds_remaining double, shotgun int, "
    "no_huddle int, red_zone_flag int, goal_line_flag int",
)
table(
    "fact_drive", "stg_drives", "game_id drive_id",
    "game_id string, drive_id int, season int, posteam string, defteam string, plays int, yards_gained double, touchdowns int, "
    "turnovers int, reached_red_zone int, drive_result string",
    lambda d: d.withColumn("turnovers", F.coalesce("interceptions", F.lit(0)) + F.coalesce("fumbles_lost", F.lit(0))),
)
table(
    "fact_team_game", "int_team_game", "game_id team",
    "game_id string, team string, opponent string, season int, week int, home_flag int, points_for int, points_against int, "
    "margin int, win_flag int, epa_per_play double, pass_epa_per_dropback double, rush_epa_per_carry double, "
    "def_epa_per_play double, success_rate double, pass_rate double, turnovers int, sacks_allowed int, red_zone_td_rate double",
)
table(
    "fact_player_game", "int_player_game", "game_id player_id",
    "game_id string, player_id string, season int, week int, team string, opponent string, position string, completions int, "
    "attempts int, passing_yards double, passing_tds int, interceptions int, carries int, rushing_yards double, rushing_tds int, "
    "targets int, receptions int, receiving_yards double, receiving_tds int, offense_snaps int, offense_snap_pct double, "
    "fantasy_points_ppr double",
    lambda d: d.filter(F.col("game_id").isNotNull()),
)
table(
    "fact_team_week", "stg_team_week", "season week team",
    "season int, week int, team string, game_id string, opponent string, home_flag int, points_for int, points_against int, win_flag int",
)
table(
    "fact_player_week", "stg_player_week", "season week player_id",
    "season int, week int, player_id string, team string, position string, targets int, receptions int, receiving_yards double, "
    "carries int, rushing_yards double, attempts int, passing_yards double, fantasy_points_ppr double",
)
table(
    "fact_snap_count", "stg_snap_counts_weekly", "season week pfr_player_id",
    "season int, week int, pfr_player_id string, team string, position string, offense_snaps int, offense_snap_pct double, "
    "defense_snaps int, defense_snap_pct double, st_snaps int, st_snap_pct double",
)
table(
    "fact_market_game", "stg_external_odds_game", "game_id market_timestamp sportsbook market_type",
    "game_id string, market_timestamp timestamp, sportsbook string, market_type string, home_spread double, total_line double, "
    "home_ml int, away_ml int, over_juice double, under_juice double",
)
table(
    "dim_stadium", "stg_stadium", "stadium_id season_start",
    "stadium_id string, stadium_name string, team string, season_start int, season_end int, latitude double, longitude double, "
    "elevation_m double, roof_type string, surface_type string, timezone string, capacity int, venue_category string, "
    "is_neutral_site int, international_game_flag int, altitude_flag int",
)
table(
    "dim_timezone_reference", "raw_team_timezone_reference", "team season",
    "team string, season int, stadium_id string, home_timezone string, latitude double, longitude double",
)
table(
    "dim_coach", "stg_coaching_context", "team season coach_role",
    "team string, season int, coach_name string, coach_role string, first_season_with_team int, is_rookie_hc int, coordinator_change_flag int",
)
table(
    "fact_market_game_close", "stg_market_close_game", "game_id market_type selection",
    "game_id string, market_type string, selection string, closing_line double, closing_price_american int, "
    "close_timestamp timestamp, source_name string, close_sportsbook>sportsbook string, ingestion_ts timestamp",
)
table(
    "fact_team_travel_game", "int_team_travel_game", "game_id team",
    "game_id string, team string, season int, week int, is_away_team int, travel_km double, travel_miles double, "
    "timezone_shift_hours double, east_to_west_flag int, west_to_east_flag int, travel_distance_bucket string, "
    "international_travel_flag int",
)
table(
    "fact_team_schedule_spot", "int_team_schedule_spot", "game_id team",
    "game_id string, team string, season int, week int, home_flag int, rest_days int, short_week_flag int, long_rest_flag int, "
    "bye_week_prior_flag int, season_opener_flag int, consecutive_road_games_prior int, consecutive_home_games_prior int, "
    "third_road_in_four_flag int, days_until_next_game_DESCRIPTIVE_ONLY int",
)
table(
    "fact_power_rating_week", "int_team_power_rating", "game_id team",
    "game_id string, team string, season int, week int, elo_rating_pregame double, elo_rating_postgame double, "
    "offensive_power double, defensive_power double, total_environment_rating double, qb_pass_epa_context double, pace_proxy double",
)


def _latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: a keyed table keeps the last write."""
    return upsert(df.limit(0), df, keys, order)


@DIMENSIONS.relation("stg_injuries_weekly", key=("season", "week", "player_id", "report_date"))
def fact_injury_status(injuries: DataFrame) -> DataFrame:
    rows = injuries.filter(F.col("report_date").isNotNull()).select(
        "season", "week", "player_id", "team", "report_date", "position", "report_status",
        F.col("report_primary_injury").alias("injury_type"), "injury_severity_score",
    )
    keys = ["season", "week", "player_id", "report_date"]
    return _latest(rows, keys, ["injury_severity_score", "report_status", "injury_type"])


@DIMENSIONS.relation("raw_depth_charts", key=("season", "week", "team", "player_id", "position", "depth_team", "formation"))
def fact_depth_chart(raw: DataFrame) -> DataFrame:
    spec = _columns(
        "season int, week int, club_code>team string, gsis_id>player_id string, position string, depth_team int, formation string"
    )
    return clean.project(raw, spec).distinct()


@DIMENSIONS.relation(
    "stg_market_game_line", key=("source_name", "sportsbook", "game_id", "market_timestamp", "market_type", "selection")
)
def fact_market_game_snapshot(lines: DataFrame) -> DataFrame:
    spec = _columns(
        "source_name string, sportsbook string, game_id string, market_timestamp_utc>market_timestamp timestamp, "
        "market_type string, selection string, season int, week int, line double, price_american int, price_decimal double, "
        "implied_prob_raw double, snapshot_type string, ingestion_ts timestamp"
    )
    rows = clean.project(lines.filter(F.col("game_id").isNotNull()), spec)
    keys = list(DIMENSIONS.relations["fact_market_game_snapshot"].key)
    return _latest(rows, keys, ["ingestion_ts", "line", "price_american"])


_HOURLY = (
    "source_name stadium_id latitude longitude weather_type weather_ts forecast_run_ts game_date season temp_f apparent_temp_f "
    "precip_in rain_in snow_in wind_mph wind_gusts_mph wind_dir_deg humidity_pct dew_point_f pressure_hpa weather_code "
    "weather_condition ingestion_ts"
)


@DIMENSIONS.relation("stg_weather_game_hourly", key=("stadium_id", "weather_ts", "weather_type"))
def fact_weather_game_hourly(hourly: DataFrame) -> DataFrame:
    # A later forecast run of the same hour replaces the earlier one.
    return _latest(hourly.select(*_HOURLY.split()), ["stadium_id", "weather_ts", "weather_type"], ["forecast_run_ts", "temp_f"])


@DIMENSIONS.relation("stg_weather_game_hourly", key=("stadium_id", "forecast_run_ts", "forecast_target_ts"))
def fact_weather_game_forecast(hourly: DataFrame) -> DataFrame:
    dropped = ("weather_type", "rain_in", "dew_point_f", "pressure_hpa")
    rows = hourly.filter("weather_type = 'forecast'").select(*[c for c in _HOURLY.split() if c not in dropped])
    rows = rows.withColumnRenamed("weather_ts", "forecast_target_ts")
    return _latest(rows, ["stadium_id", "forecast_run_ts", "forecast_target_ts"], ["temp_f"])


def key_checks(frames: dict[str, DataFrame]) -> dict:
    """Every declared key is unique and complete, and the teams of games exist."""
    checks = {}
    for name, relation in DIMENSIONS.relations.items():
        if name in frames and relation.key:
            keys = list(relation.key)
            checks[f"{name}_key"] = lambda n=name, k=keys: quality.key(frames[n], k)
    for side in ("home", "away"):
        checks[f"dim_game_{side}_team"] = lambda s=side: quality.relationships(
            frames["dim_game"], frames["dim_team"].select(F.col("team_abbr").alias(f"{s}_team")), [f"{s}_team"]
        )
    return checks
