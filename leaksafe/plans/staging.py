"""Staging relations: raw tables typed, renamed, and brought to canonical codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.clocks import at_clock, local_to_utc, minutes_between
from leaksafe.functions.features import code_ranges, flag, outcome_flag
from leaksafe.functions.odds import key_distance, side_totals
from leaksafe.operators import asof, clean, events, horizons, joins, reshape
from leaksafe.operators.consensus import consensus_columns
from leaksafe.operators.events import Agg
from leaksafe.plans.catalog import Catalog

STAGING = Catalog()

# Legacy team codes.
TEAM_CODES = {"OAK": "LV", "SD": "LAC", "STL": "LA"}
# Positions and their groups.
POSITION_GROUPS = {
    "QB": "QB", "HB": "RB", "RB": "RB", "FB": "RB", "WR": "WR", "TE": "TE", "C": "OL", "G": "OL", "T": "OL",
    "DE": "DL", "DT": "DL", "NT": "DL", "ILB": "LB", "OLB": "LB", "MLB": "LB", "CB": "CB", "DB": "S", "FS": "S",
    "SS": "S", "K": "K", "P": "P",
}
# Injury report levels.
INJURY_LEVELS = {"OUT": 4, "DOUBTFUL": 3, "QUESTIONABLE": 2, "LIMITED": 1}
# Weather codes.
WEATHER_CODES = [
    (0, 0, "Clear"), (1, 3, "Partly Cloudy"), (45, 48, "Fog"), (51, 67, "Rain"), (71, 77, "Snow"),
    (80, 82, "Rain Showers"), (85, 86, "Snow Showers"), (95, 99, "Thunderstorm"),
]
# Key numbers of the proximity columns.
SPREAD_KEYS = (3, 6, 7, 10, 14)
TOTAL_KEYS = (37, 38, 41, 44, 45, 47, 48, 51)
KM_PER_MILE = 1.60934
DEFAULT_REST = 7
POSTSEASON = ("WC", "DIV", "CON", "SB")
NOT_A_PLAY = ("no_play", "kickoff", "extra_point")


def team(col: str) -> Column:
    return clean.remap_expr(col, TEAM_CODES)


def same(names: str, dtype: str | None = None, default=None) -> dict:
    """Columns kept under their own name with one type."""
    return {n: (n, dtype, default) for n in names.split()}


def renamed(pairs: str, dtype: str | None = None, default=None) -> dict:
    """'source:output' pairs with one type."""
    return {p.split(":")[1]: (p.split(":")[0], dtype, default) for p in pairs.split()}


@STAGING.relation("raw_schedules", key=("game_id",))
def stg_games(raw: DataFrame) -> DataFrame:
    home, away = (F.col(c).try_cast("int") for c in ("home_score", "away_score"))
    evening = F.split_part(F.coalesce("gametime", F.lit("13:00")), F.lit(":"), F.lit(1)).try_cast("int") >= 20
    day = F.upper("weekday")
    kind = (
        F.when(F.col("game_type") == "REG", "regular")
        .when(F.col("game_type").isin(*POSTSEASON), "postseason")
        .when(F.col("game_type") == "PRE", "preseason")
        .otherwise("unknown")
    )
    return clean.project(
        raw.filter("game_type != 'PRE'"),
        {
            **same("game_id old_game_id"),
            **same("season week", "int"),
            "game_type": "game_type",
            "season_type": kind,
            "game_date": ("gameday", "date"),
            "kickoff_time_local": ("gametime", "string"),
            "weekday": "weekday",
            "home_team": team("home_team"),
            "away_team": team("away_team"),
            "home_score": home,
            "away_score": away,
            "total_points": home + away,
            "home_margin": home - away,
            "home_win_flag": outcome_flag(home, away),
            "game_completed_flag": flag(home.isNotNull()),
            **same("location stadium stadium_id"),
            "surface": F.upper(F.coalesce("surface", F.lit("unknown"))),
            "roof": F.upper(F.coalesce("roof", F.lit("unknown"))),
            "div_game": ("div_game", "int", 0),
            "conf_game": ("div_game", "int", 0),  # the source has no conference flag
            "primetime_flag": flag(day.isin("MONDAY", "THURSDAY") | ((day == "SUNDAY") & evening)),
            "away_rest_days": ("away_rest", "int", DEFAULT_REST),
            "home_rest_days": ("home_rest", "int", DEFAULT_REST),
            "schedule_spread_line": F.col("spread_line").try_cast("double"),
            "schedule_total_line": F.col("total_line").try_cast("double"),
            "schedule_away_ml": F.col("away_moneyline").try_cast("double"),
            "schedule_home_ml": F.col("home_moneyline").try_cast("double"),
            **renamed("pfr:pfr_game_id pff:pff_game_id espn:espn_game_id nfl_detail_id:nfl_detail_id"),
            "ingestion_ts": F.current_timestamp(),
        },
    )


@STAGING.relation("raw_pbp", key=("game_id", "play_id"))
def stg_plays(raw: DataFrame) -> DataFrame:
    kind = F.when(F.col("season_type") == "REG", "regular").when(F.col("season_type") == "POST", "postseason")
    return clean.project(
        clean.exclude(raw, "play_type", NOT_A_PLAY, keep_null=True),
        {
            "game_id": "game_id",
            **same("play_id season week", "int"),
            "game_date": "game_date",
            **renamed("qtr:quarter down:down", "int"),
            **{c: team(c) for c in ("posteam", "defteam", "home_team", "away_team")},
            **same("ydstogo yardline_100 posteam_score defteam_score", "int"),
            **same("score_differential game_seconds_remaining half_seconds_remaining", "double"),
            **renamed("quarter_seconds_remaining:qtr_seconds_remaining", "double"),
            **renamed("posteam_timeouts_remaining:posteam_timeouts defteam_timeouts_remaining:defteam_timeouts", "int"),
            "play_type": "play_type",
            **renamed("qb_scramble:scramble", "int"),
            **same("pass_attempt rush_attempt sack qb_spike qb_kneel penalty punt_attempt field_goal_attempt", "int"),
            **same("two_point_attempt extra_point_attempt shotgun no_huddle success complete_pass", "int"),
            **same("incomplete_pass interception touchdown fumble fumble_lost special_teams_play", "int"),
            **same("air_yards yards_after_catch yards_gained epa wpa air_epa yac_epa comp_air_epa comp_yac_epa", "double"),
            **same("passer_id passer rusher_id rusher receiver_id receiver"),
            **renamed("fixed_drive:drive_id", "int"),
            "drive_result": "fixed_drive_result",
            "st_play_type": ("st_play_type", "string"),
            "red_zone_flag": flag(F.col("yardline_100") <= 20),
            "goal_line_flag": flag(F.col("yardline_100") <= 5),
            "two_minute_flag": flag(F.col("half_seconds_remaining") <= 120),
            "season_type": F.coalesce(kind, "season_type", F.lit("regular")),
            "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_pbp", key=("game_id", "drive_id"))
def stg_drives(raw: DataFrame) -> DataFrame:
    plays = raw.filter(F.col("fixed_drive").isNotNull() & ~F.col("play_type").isin(*NOT_A_PLAY)).withColumns(
        {"drive_id": F.col("fixed_drive").cast("int"), "season": F.col("season").cast("int"),
         "posteam": team("posteam"), "defteam": team("defteam")}
    )
    total = lambda c, t="int": Agg("sum", F.col(c).cast(t))
    return events.rollup(
        plays,
        ["game_id", "drive_id", "season", "posteam", "defteam"],
        {
            "end_yardline_100": Agg("min", "yardline_100"),
            "start_yardline_100": Agg("max", "yardline_100"),
            "plays": Agg("count"),
            "yards_gained": total("yards_gained", "double"),
            "pass_attempts": total("pass_attempt"),
            "rush_attempts": total("rush_attempt"),
            "touchdowns": total("touchdown"),
            "penalties": total("penalty"),
            "fumbles_lost": total("fumble_lost"),
            "interceptions": total("interception"),
            "reached_red_zone": Agg("max", flag(F.col("yardline_100") <= 20)),
            "drive_result": Agg("max", "fixed_drive_result"),
            "ingestion_ts": Agg("min", "ingestion_ts"),
        },
    )


@STAGING.relation("raw_schedules", "raw_rosters", key=("team_abbr",))
def stg_teams(schedules: DataFrame, rosters: DataFrame) -> DataFrame:
    sources = [(schedules, "home_team"), (schedules, "away_team"), (rosters, "team")]
    unknown = F.lit(None).cast("string")
    return clean.canonical_entities(sources, TEAM_CODES, out="team_abbr").select(
        "team_abbr", *[unknown.alias(c) for c in ("team_name", "team_conf", "team_division")]
    )


@STAGING.relation("raw_players", key=("player_id",))
def stg_players(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw.filter(F.col("gsis_id").isNotNull()),
        {
            "player_id": ("gsis_id", "string"),
            "full_name": "display_name",
            **same("first_name last_name"),
            "position": F.upper("position"),
            "position_group": F.coalesce(clean.remap_expr(F.upper("position"), POSITION_GROUPS, "OTHER"), F.lit("OTHER")),
            "birth_date": "birth_date",
            **renamed("college_name:college height:height weight:weight draft_year:entry_year rookie_season:rookie_year"),
            **renamed("draft_team:draft_club draft_pick:draft_number"),
            "active_flag": flag(F.col("status") == "ACT"),
            **renamed("headshot:headshot_url short_name:short_name ingestion_ts:ingestion_ts"),
        },
    )


@STAGING.relation("raw_player_stats", key=("season", "week", "player_id"))
def stg_player_week(raw: DataFrame) -> DataFrame:
    counts = (
        "completions attempts passing_tds sack_fumbles sack_fumbles_lost carries rushing_tds rushing_fumbles "
        "rushing_fumbles_lost rushing_first_downs targets receptions receiving_tds receiving_fumbles "
        "receiving_fumbles_lost receiving_first_downs"
    )
    amounts = (
        "passing_yards passing_air_yards passing_epa rushing_yards rushing_epa receiving_yards receiving_air_yards "
        "receiving_epa target_share air_yards_share wopr racr pacr"
    )
    return clean.project(
        raw.filter(F.col("player_id").isNotNull() & F.col("season_type").isin("REG", "POST")),
        {
            "player_id": ("player_id", "string"),
            "full_name": "player_display_name",
            "position": F.upper("position"),
            "position_group": F.upper("position_group"),
            **renamed("team:team opponent_team:opponent"),
            **same("season week", "int"),
            "season_type": "season_type",
            **same(counts, "int", 0),
            **renamed("passing_interceptions:interceptions sacks_suffered:sacks", "int", 0),
            **same(amounts, "double", 0.0),
            **renamed(
                "sack_yards_lost:sack_yards passing_yards_after_catch:passing_yac passing_cpoe:dakota "
                "receiving_yards_after_catch:receiving_yac",
                "double", 0.0,
            ),
            "fantasy_points_std": F.col("fantasy_points").try_cast("double"),
            "fantasy_points_ppr": F.col("fantasy_points_ppr").try_cast("double"),
            "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_schedules", key=("game_id", "team"))
def stg_team_week(raw: DataFrame) -> DataFrame:
    played = clean.project(
        raw.filter("game_type != 'PRE'"),
        {
            "game_id": "game_id", **same("season week", "int"), "game_type": "game_type", "game_date": ("gameday", "date"),
            "home": team("home_team"), "away": team("away_team"),
            "home_score": F.col("home_score").try_cast("int"), "away_score": F.col("away_score").try_cast("int"),
        },
    )
    sides = reshape.two_sides(
        played,
        {"team": "home", "opponent": "away", "points_for": "home_score", "points_against": "away_score"},
        {"team": "away", "opponent": "home", "points_for": "away_score", "points_against": "home_score"},
        keep=["game_id", "season", "week", "game_type", "game_date"],
    )
    return sides.filter(F.col("team").isNotNull()).select(
        "game_id", "season", "week", "game_type", "game_date", "team", "opponent", "home_flag", "points_for", "points_against",
        (F.col("points_for") - F.col("points_against")).alias("margin"),
        outcome_flag("points_for", "points_against").alias("win_flag"),
        F.when(F.col("game_type") == "REG", "regular").otherwise("postseason").alias("season_type"),
    )


@STAGING.relation("raw_rosters_weekly", key=("season", "week", "team", "player_id"))
def stg_rosters_weekly(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw.filter(F.col("gsis_id").isNotNull() & F.col("week").isNotNull()),
        {
            "player_id": ("gsis_id", "string"), "full_name": "full_name", "position": F.upper("position"),
            "depth_chart_position": "depth_chart_position", "team": team("team"), **same("season week", "int"),
            **same("status jersey_number"), "years_exp": ("years_exp", "int"), "ingestion_ts": "ingestion_ts",
        },
    )


def severity(col: str) -> Column:
    pairs = [F.lit(x) for item in INJURY_LEVELS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(F.col(col))), F.lit(0))


@STAGING.relation("raw_injuries")
def stg_injuries_weekly(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw.filter(F.col("gsis_id").isNotNull()),
        {
            "player_id": ("gsis_id", "string"), "full_name": "full_name", "position": F.upper("position"), "team": team("team"),
            **same("season week", "int"), "report_date": F.col("date_modified").cast("timestamp").cast("date"),
            **same("report_primary_injury report_secondary_injury report_status practice_primary_injury"),
            **same("practice_secondary_injury practice_status"),
            "injury_severity_score": severity("report_status"), "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_snap_counts", key=("season", "week", "team", "pfr_player_id"))
def stg_snap_counts_weekly(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw.filter(F.col("pfr_player_id").isNotNull()),
        {
            "pfr_player_id": "pfr_player_id", "full_name": "player", "position": F.upper("position"), "team": team("team"),
            "opponent": "opponent", **same("season week offense_snaps defense_snaps st_snaps", "int"),
            **renamed("offense_pct:offense_snap_pct defense_pct:defense_snap_pct st_pct:st_snap_pct", "double"),
            "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_nextgen_stats", key=("season", "week", "player_id", "stat_type"))
def stg_nextgen_player_week(raw: DataFrame) -> DataFrame:
    measured = (
        "avg_cushion avg_expected_yac avg_intended_air_yards avg_separation avg_yac avg_yac_above_expectation "
        "catch_percentage yards"
    )
    return clean.project(
        raw.filter(F.col("player_gsis_id").isNotNull()),
        {
            "player_id": ("player_gsis_id", "string"), "full_name": "player_display_name",
            "position": F.upper("player_position"), "team": team("team_abbr"), **same("season week", "int"),
            **same("stat_type season_type"),
            **{c: F.col(c).try_cast("double") for c in measured.split()},
            "intended_air_yards_share": F.col("percent_share_of_intended_air_yards").try_cast("double"),
            **{c: F.col(c).try_cast("int") for c in ("rec_touchdowns", "receptions", "targets")},
            "ingestion_ts": "ingestion_ts",
        },
    )


EXTERNAL_ODDS = (
    "game_id string, season int, week int, game_date date, home_team string, away_team string, market_timestamp timestamp, "
    "sportsbook string, market_type string, home_spread double, away_spread double, spread_juice_home double, "
    "spread_juice_away double, total_line double, over_juice double, under_juice double, home_ml int, away_ml int, "
    "opening_spread double, opening_total double, closing_spread double, closing_total double, ingestion_ts timestamp"
)


@STAGING.relation("raw_schedules")
def stg_external_odds_game(raw: DataFrame) -> DataFrame:
    """Typed table without rows: no external feed is loaded."""
    return raw.sparkSession.createDataFrame([], EXTERNAL_ODDS)


@STAGING.relation("raw_market_odds_snapshot", "raw_schedules", materialise=True, partition=("season",), deal=("game_id",))
def stg_market_game_line(raw: DataFrame, schedules: DataFrame) -> DataFrame:
    games = schedules.filter("game_type != 'PRE'").select(
        "game_id", F.col("season").cast("int").alias("season"), "home_team", "away_team", F.col("gameday").cast("date").alias("__day")
    )
    typed = clean.project(
        raw,
        {
            **same("source_name sportsbook event_id game_id"), **same("season week", "int"),
            "market_timestamp_utc": ("market_timestamp", "timestamp"), "game_datetime_utc": ("game_datetime", "timestamp"),
            **same("home_team away_team"), "market_type": F.lower("market_type"), "selection": F.lower("selection"),
            "line": ("line", "double"), "price_american": ("price_american", "int"), "price_decimal": ("price_decimal", "double"),
            "implied_prob_raw": ("implied_probability_raw", "double"), "overunder_line": ("overunder_line", "double"),
            "snapshot_type": F.lower("snapshot_type"), "ingestion_ts": "ingestion_ts",
            "__day": F.col("game_datetime").cast("date"),
        },
    )
    # Rows whose game stays unknown are spread by their event.
    place = F.coalesce("game_id", "event_id")
    rows = joins.fill_key(typed, games, ["home_team", "away_team", "season", "__day"], "game_id", place).drop("__day")
    home_spread = (F.col("market_type") == "spread") & (F.col("selection") == "home")
    sides = side_totals("overunder_line", "line")
    return rows.withColumns(
        {
            "implied_home_team_total": F.when(home_spread, sides.getField("home")),
            "implied_away_team_total": F.when(home_spread, sides.getField("away")),
            "home_favorite_flag": flag(home_spread & (F.col("line") < 0)),
            "home_underdog_flag": flag(home_spread & (F.col("line") > 0)),
            "spread_key_number_distance": F.when(F.col("market_type") == "spread", key_distance("line", SPREAD_KEYS)),
            "total_key_number_distance": F.when(
                F.col("market_type") == "total", key_distance("line", TOTAL_KEYS, absolute=False)
            ),
        }
    )


@STAGING.relation("stg_market_game_line")
def stg_market_consensus_game(lines: DataFrame) -> DataFrame:
    rows = lines.filter(F.col("game_id").isNotNull()).withColumnRenamed("market_timestamp_utc", "market_timestamp")
    keys = ["game_id", "season", "week", "market_timestamp", "market_type", "selection", "snapshot_type"]
    out = rows.groupBy(*keys).agg(
        *consensus_columns("sportsbook", "line"),
        F.avg("implied_prob_raw").alias("avg_implied_prob"),
        F.max("ingestion_ts").alias("ingestion_ts"),
    )
    return out.withColumnsRenamed({"line_min": "min_line", "line_max": "max_line"})


LINE_TIE = ("source_name", "sportsbook", "event_id")


@STAGING.relation("stg_market_game_line", key=("game_id", "market_type", "selection"))
def stg_market_close_game(lines: DataFrame) -> DataFrame:
    closing = lines.filter((F.col("snapshot_type") == "closing") & F.col("game_id").isNotNull())
    last = asof.last_per_key(closing, ["game_id", "market_type", "selection"], "market_timestamp_utc", LINE_TIE)
    last = last.withColumnsRenamed(
        {
            "market_timestamp_utc": "close_timestamp", "line": "closing_line", "price_american": "closing_price_american",
            "price_decimal": "closing_price_decimal", "implied_prob_raw": "closing_implied_prob", "sportsbook": "close_sportsbook",
        }
    )
    return last.select(
        "game_id", "season", "week", "home_team", "away_team", "market_type", "selection", "close_timestamp", "closing_line",
        "closing_price_american", "closing_price_decimal", "closing_implied_prob", "implied_home_team_total",
        "implied_away_team_total", "home_favorite_flag", "home_underdog_flag", "spread_key_number_distance",
        "total_key_number_distance", "close_sportsbook", "source_name", "ingestion_ts",
    )


@STAGING.relation("raw_weather_hourly_history", "raw_weather_forecast_hourly")
def stg_weather_game_hourly(history: DataFrame, forecast: DataFrame) -> DataFrame:
    return clean.project(
        history.unionByName(forecast, allowMissingColumns=True),
        {
            **same("source_name stadium_id"), **same("latitude longitude", "double"), "weather_type": "weather_type",
            "weather_ts": ("observation_or_forecast_ts", "timestamp"), "forecast_run_ts": ("forecast_run_ts", "timestamp"),
            "game_date": ("game_date", "date"), "season": ("season", "int"),
            **renamed(
                "temperature_2m:temp_f apparent_temperature:apparent_temp_f precipitation:precip_in rain:rain_in "
                "snowfall:snow_in snow_depth:snow_depth_in wind_speed_10m:wind_mph wind_gusts_10m:wind_gusts_mph",
                "double",
            ),
            "wind_dir_deg": ("wind_direction_10m", "int"),
            **renamed("relative_humidity_2m:humidity_pct dew_point_2m:dew_point_f surface_pressure:pressure_hpa", "double"),
            "weather_code": ("weather_code", "int"),
            "weather_condition": code_ranges(F.col("weather_code").cast("int"), WEATHER_CODES, "Other"),
            "ingestion_ts": "ingestion_ts",
        },
    )


WEATHER = (
    "temp_f", "apparent_temp_f", "precip_in", "rain_in", "snow_in", "snow_depth_in", "wind_mph", "wind_gusts_mph",
    "wind_dir_deg", "humidity_pct", "dew_point_f", "pressure_hpa", "weather_code", "weather_condition",
)


def weather_at_kickoff(
    games: DataFrame, stadiums: DataFrame, hourly: DataFrame, *, zone_mode: str = "approx", forecast_hours: int | None = None,
    by_horizon: bool = False,
) -> DataFrame:
    """One weather row per game: the observation nearest to kickoff.

    `zone_mode="approx"` reads the local clock as UTC; "venue" converts it with the stadium's
    zone. With `forecast_hours` the latest forecast run made that long before kickoff is used
    instead of the observation, which keeps the columns safe before the game. `by_horizon` gives
    a row for each prediction horizon, with the forecast known then.
    """
    clock = F.concat_ws(
        ":",
        F.coalesce(F.split_part("kickoff_time_local", F.lit(":"), F.lit(1)).try_cast("int"), F.lit(13)).cast("string"),
        F.coalesce(F.split_part("kickoff_time_local", F.lit(":"), F.lit(2)).try_cast("int"), F.lit(0)).cast("string"),
    )
    kicked = games.withColumn("kickoff_ts_approx", at_clock("game_date", clock).cast("timestamp"))
    venues = stadiums.select(
        "stadium_id", F.col("team").alias("home_team"), "season_start", "season_end",
        F.col("roof_type").alias("metadata_roof_type"), "timezone",
    )
    kicked = joins.validity_join(kicked.drop("stadium_id"), venues, "home_team", "season")
    if zone_mode == "venue":
        kicked = kicked.withColumn("kickoff_ts_approx", local_to_utc("kickoff_ts_approx", "timezone"))
    kicked = kicked.select(
        "game_id", "season", "week", "game_date", "kickoff_ts_approx", "stadium_id", "roof", "metadata_roof_type"
    )
    if by_horizon:
        kicked = horizons.expand(kicked)
    hourly = hourly.withColumn("__tie", F.coalesce("weather_code", F.lit(-1)))
    taken = [*WEATHER, "weather_type", "forecast_run_ts"]
    if forecast_hours is None and not by_horizon:
        rows = hourly.filter(F.col("weather_type") == "historical").select("stadium_id", "game_date", "weather_ts", "__tie", *taken)
        out = asof.nearest(
            kicked, rows, ["stadium_id", "game_date"], "kickoff_ts_approx", "weather_ts", "__tie", cols=["weather_ts", *taken]
        )
    else:
        hours = F.col("hours_before_event") if by_horizon else F.lit(forecast_hours)
        kicked = kicked.withColumn("__cutoff", F.timestamp_add("HOUR", -hours, F.col("kickoff_ts_approx")))
        rows = hourly.filter(F.col("weather_type") == "forecast").select("stadium_id", "weather_ts", "__tie", *taken)
        rows = rows.withColumn("run", F.col("forecast_run_ts"))
        out = asof.latest_safe_forecast(
            kicked, rows, ["stadium_id"], "__cutoff", "run", "kickoff_ts_approx", "weather_ts", "__tie", ["weather_ts", *taken]
        ).drop("__cutoff")
    dome = F.lower("metadata_roof_type") == "dome"
    shut = (F.lower("metadata_roof_type") == "retractable") & F.lower("roof").isin("closed", "dome")
    closed = flag(dome | shut)
    return out.select(
        "game_id", *(["prediction_horizon", "hours_before_event"] if by_horizon else []), "season", "week", "game_date",
        "kickoff_ts_approx", "stadium_id", "roof", "metadata_roof_type", *WEATHER,
        F.abs(minutes_between("weather_ts", "kickoff_ts_approx")).alias("weather_obs_minutes_from_kickoff"),
        F.col("weather_type").alias("weather_source_type"), "forecast_run_ts",
        closed.alias("roof_closed_flag"), (1 - closed).alias("open_air_weather_applicable"),
    )


@STAGING.relation("stg_games", "raw_stadium_metadata", "stg_weather_game_hourly", key=("game_id",), materialise=True, partition=("season",))
def stg_weather_game_kickoff(games: DataFrame, stadiums: DataFrame, hourly: DataFrame) -> DataFrame:
    return weather_at_kickoff(games, stadiums, hourly)


@STAGING.relation("raw_stadium_metadata", key=("stadium_id", "season_start"))
def stg_stadium(raw: DataFrame) -> DataFrame:
    roof = F.lower("roof_type")
    category = F.when(roof == "dome", "indoor").when(roof == "retractable", "retractable").otherwise("outdoor")
    return clean.project(
        raw,
        {
            **same("stadium_id stadium_name"), "team": team("team"), **same("season_start season_end", "int"),
            **same("latitude longitude elevation_m", "double"), "roof_type": roof, "surface_type": F.lower("surface_type"),
            "timezone": "timezone", **same("capacity international_game_flag altitude_flag", "int"),
            "is_neutral_site": ("is_neutral_site_default", "int"), "venue_category": category, "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_team_travel_reference", key=("season", "home_team", "away_team"))
def stg_travel_context(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw,
        {
            "season": ("season", "int"), **same("home_team away_team"), "travel_km": ("travel_km", "double"),
            "travel_miles": F.round(F.col("travel_km").cast("double") / KM_PER_MILE, 1),
            "timezone_shift_hours": ("timezone_shift_hours", "double"),
            **same("east_to_west_flag west_to_east_flag international_travel_flag", "int"), "ingestion_ts": "ingestion_ts",
        },
    )


@STAGING.relation("raw_coach_reference", key=("team", "season", "coach_role"))
def stg_coaching_context(raw: DataFrame) -> DataFrame:
    return clean.project(
        raw,
        {
            "team": team("team"), "season": ("season", "int"), "coach_name": "coach_name", "coach_role": F.upper("coach_role"),
            **same("first_season_with_team is_rookie_hc coordinator_change_flag", "int"), "ingestion_ts": "ingestion_ts",
        },
    )
