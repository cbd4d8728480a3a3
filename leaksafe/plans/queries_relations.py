"""Every relation and table as a query over the derived raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.operators import quality
from leaksafe.plans import data_tests, relation_sql
from leaksafe.plans.dimensions import DIMENSIONS, key_checks
from leaksafe.plans.registry import query
from leaksafe.plans.relations import CATALOG, relations

# Columns that are not numbers; all others are rounded before they are compared.
TEXT = """
away_team away_team_home_tz birth_date bucket_timestamp close_sportsbook close_timestamp coach_name coach_role college
conference country current_abbr cv_split defteam depth_chart_position division draft_club drive_result espn_game_id espn_id
event_id first_name forecast_run_ts forecast_target_ts formation full_name game_date game_datetime_utc game_id
game_location_team game_type game_venue_tz headshot_url home_team home_timezone injury_status injury_type kickoff_time
kickoff_time_local kickoff_ts_approx last_name location market_timestamp market_timestamp_utc market_type
metadata_roof_type nfl_detail_id old_game_id open_timestamp opponent passer passer_id pff_game_id pfr_game_id pfr_id
pfr_player_id play_type player_id position position_group posteam practice_primary_injury practice_secondary_injury
practice_status prediction_horizon receiver receiver_id report_date report_primary_injury report_secondary_injury
report_status roof roof_type rusher rusher_id season_end_date season_start_date season_type selection short_name sleeper_id
snapshot_type source_name sportsbook st_play_type stadium stadium_id stadium_name stadium_roof_type stadium_surface_type
stat_type status surface surface_type team team_abbr team_color team_color2 team_conf team_division team_logo_url team_name
temp_bucket time_bucket timezone travel_distance_bucket venue_category weather_condition weather_source_type weather_ts
weather_type week_end_date week_start_date weekday wind_bucket
""".split()
DIGITS = 6
ALL_TEXT = {"stg_teams"}
# Typed tables without rows, and seeds: nothing in them depends on the data.
NOT_QUERIED = {"stg_external_odds_game", "fact_market_game", "dim_position_group", "dim_sportsbook", "dim_market_type"}


def comparable(df: DataFrame) -> DataFrame:
    """Without ingestion time, doubles rounded, instants as UTC wall-clock."""
    columns = []
    for name, dtype in df.dtypes:
        if name == "ingestion_ts":
            continue
        col = F.col(f"`{name}`")
        if dtype in ("double", "float"):
            col = F.round(col, DIGITS)
        elif dtype == "timestamp":
            col = col.cast("timestamp_ntz")
        columns.append(col.alias(name))
    return df.select(*columns)


def _final(name: str) -> str:
    listed = ", ".join(f"'{c}'" for c in TEXT)
    if name in ALL_TEXT:
        return f"SELECT * FROM {name}"
    # Adding 0 turns a rounded −0 into 0.
    return (
        f"SELECT COLUMNS(lambda c: c IN ({listed})), "
        f"ROUND(COLUMNS(lambda c: c NOT IN ({listed}) AND c != 'ingestion_ts'), {DIGITS}) + 0 FROM {name}"
    )


def _register(name: str) -> None:
    sql = relation_sql.compose(name, _final(name)) if name in relation_sql.SQL else None

    @query(name, sql)
    def build(spark: SparkSession, sf: str) -> DataFrame:
        return comparable(relations(spark, sf)[name])


for _name in CATALOG.relations:
    if _name not in NOT_QUERIED:
        _register(_name)


class _Frames(dict):
    """Relations by name, built when asked for."""

    def __init__(self, source):
        super().__init__()
        self.source = source

    def __missing__(self, name):
        return self.source[name]

    def __contains__(self, name):
        return name in CATALOG.relations


_COUNTS = {
    "plays_unique": "(SELECT 1 FROM raw_pbp GROUP BY game_id, play_id HAVING COUNT(*) > 1)",
    "games_unique": "(SELECT 1 FROM stg_games GROUP BY game_id HAVING COUNT(*) > 1)",
    "scores_in_range": "(SELECT 1 FROM stg_games WHERE home_score NOT BETWEEN 0 AND 80 UNION ALL SELECT 1 FROM stg_games WHERE away_score NOT BETWEEN 0 AND 80)",
    "player_week_unique": "(SELECT 1 FROM stg_player_week GROUP BY season, week, player_id, position HAVING COUNT(*) > 1)",
    "no_form_in_first_week": "(SELECT 1 FROM int_team_form WHERE week = 1 AND games_played_std > 0)",
    "home_team_known": "(SELECT 1 FROM stg_games WHERE home_team NOT IN (SELECT team_abbr FROM stg_teams))",
    "season_in_range": "(SELECT 1 FROM raw_pbp GROUP BY season HAVING season NOT BETWEEN 1999 AND 2030)",
    "points_not_too_low": "(SELECT 1 FROM stg_player_week WHERE fantasy_points_ppr < -20)",
    "market_types": "(SELECT 1 FROM stg_market_game_line WHERE market_type NOT IN ('spread', 'total', 'moneyline', 'team_total', 'player_prop'))",
    "probability_in_range": "(SELECT 1 FROM stg_market_game_line WHERE implied_prob_raw < 0 OR implied_prob_raw > 1)",
    "opening_spread_in_range": "(SELECT 1 FROM int_market_open_close WHERE market_type = 'spread' AND selection = 'home' AND abs(opening_line) > 30)",
    "opening_total_in_range": "(SELECT 1 FROM int_market_open_close WHERE market_type = 'total' AND selection = 'over' AND opening_line NOT BETWEEN 25 AND 80)",
    "temperature_in_range": "(SELECT 1 FROM stg_weather_game_hourly WHERE temp_f NOT BETWEEN -50 AND 130)",
    "closed_roof_scores_zero": "(SELECT 1 FROM int_weather_game WHERE roof_closed_flag = 1 AND adverse_weather_score > 0)",
    "stadium_known": "(SELECT 1 FROM stg_games g LEFT JOIN stg_stadium s ON g.home_team = s.team AND g.season BETWEEN s.season_start AND s.season_end WHERE s.stadium_id IS NULL AND g.location != 'Neutral' AND g.game_completed_flag = 1)",
    "home_team_does_not_travel": "(SELECT 1 FROM int_team_travel_game WHERE is_away_team = 0 AND travel_km > 1)",
    "rating_in_range": "(SELECT 1 FROM int_team_power_rating WHERE elo_rating_pregame NOT BETWEEN 1000 AND 2000)",
    "rating_unique": "(SELECT 1 FROM int_team_power_rating GROUP BY game_id, team HAVING COUNT(*) > 1)",
    "snapshots_before_kickoff": "(SELECT 1 FROM int_market_time_buckets WHERE hours_before_kickoff < 0)",
    "games_not_null": "(SELECT 1 FROM stg_games WHERE game_id IS NULL)",
    "player_week_not_null": "(SELECT 1 FROM stg_player_week WHERE player_id IS NULL)",
    "team_game_unique": "(SELECT 1 FROM int_team_game GROUP BY game_id, team HAVING COUNT(*) > 1)",
    "completed_games_have_scores": "(SELECT 1 FROM stg_games WHERE game_completed_flag = 1 AND (home_score IS NULL OR away_score IS NULL))",
    "away_team_known": "(SELECT 1 FROM stg_games WHERE away_team NOT IN (SELECT team_abbr FROM stg_teams))",
    "severity_values": "(SELECT 1 FROM stg_injuries_weekly WHERE injury_severity_score NOT IN (0, 1, 2, 3, 4))",
    "injury_impact_unique": "(SELECT 1 FROM int_injury_team_impact GROUP BY team, season, week HAVING COUNT(*) > 1)",
    "bucket_labels": "(SELECT 1 FROM int_market_time_buckets WHERE time_bucket NOT IN ('open', '72h', '24h', '6h', '1h', 'close'))",
    "wind_not_negative": "(SELECT 1 FROM stg_weather_game_hourly WHERE wind_mph < 0)",
    "forecast_has_run": "(SELECT 1 FROM stg_weather_game_hourly WHERE weather_type = 'forecast' AND forecast_run_ts IS NULL)",
    "travel_not_negative": "(SELECT 1 FROM int_team_travel_game WHERE travel_km < 0)",
    "forecast_before_kickoff": "(SELECT 1 FROM int_weather_game w JOIN stg_weather_game_kickoff k USING (game_id) WHERE w.weather_source_type = 'forecast' AND w.forecast_run_ts > k.kickoff_ts_approx)",
    # The last two are tests of the mart's columns.
    "backtest_has_no_close": "(SELECT 1 WHERE FALSE)",
    "backtest_has_weather_source": "(SELECT 1 WHERE FALSE)",
}
_USED = [
    "raw_pbp", "stg_games", "stg_player_week", "int_team_form", "stg_teams", "stg_market_game_line", "int_market_open_close",
    "stg_weather_game_hourly", "int_weather_game", "stg_stadium", "int_team_travel_game", "int_team_power_rating",
    "int_market_time_buckets", "int_team_game", "stg_injuries_weekly", "int_injury_team_impact", "stg_weather_game_kickoff",
]
_REPORT = " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, COUNT(*) AS rows FROM {s} t"
    for n, s in _COUNTS.items()
)


@query("relation_tests", relation_sql.compose_all(_USED, _REPORT))
def relation_tests(spark, sf):
    """All 33 tests. Those on one relation share its scan."""
    return data_tests.run_all(spark, _Frames(relations(spark, sf)))


@query("relation_tests_all", relation_sql.compose_all(_USED, _REPORT))
def relation_tests_all(spark, sf):
    """The same, for those who call it by its former name."""
    return relation_tests(spark, sf)


# The declared keys of all relations that have SQL.
_KEYS = {n: list(r.key) for n, r in DIMENSIONS.relations.items() if r.key and n in relation_sql.SQL and n not in NOT_QUERIED}
_KEY_REPORT = " UNION ALL ".join(
    f"SELECT '{n}_key' AS check_name, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, COUNT(*) AS rows FROM "
    f"(SELECT 1 FROM {n} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1 OR {' OR '.join(f'{c} IS NULL' for c in k)}) t"
    for n, k in _KEYS.items()
)


def _key_rules(names) -> list[quality.Rule]:
    """Each declared key is unique and complete: two rules, one scan."""
    out = []
    for name in names:
        keys = DIMENSIONS.relations[name].key
        out += [quality.Rule(name, f"{name}_key", unique=keys), quality.Rule(name, f"{name}_key_complete", quality.any_null(*keys))]
    return out


@query("relation_keys", relation_sql.compose_all(list(_KEYS), _KEY_REPORT))
def relation_keys(spark, sf):
    wanted = key_checks(_Frames(relations(spark, sf)))
    return quality.run(spark, {f"{n}_key": wanted[f"{n}_key"] for n in _KEYS})


_ALL_KEYS = {n: list(r.key) for n, r in DIMENSIONS.relations.items() if r.key}
_SEEDS = [n for n in _ALL_KEYS if n not in _KEYS]  # typed or seeded tables that no data can change
_COMPLETE_REPORT = " UNION ALL ".join(
    [
        f"SELECT '{n}_key{suffix}' AS check_name, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, COUNT(*) AS rows FROM ({part}) t"
        for n, k in _KEYS.items()
        for suffix, part in (
            ("", f"SELECT 1 FROM {n} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1"),
            ("_complete", f"SELECT 1 FROM {n} WHERE {' OR '.join(f'{c} IS NULL' for c in k)}"),
        )
    ]
    + [f"SELECT '{n}_key{suffix}', 'PASS', 0" for n in _SEEDS for suffix in ("", "_complete")]
    + [
        f"SELECT 'dim_game_{side}_team', CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END, COUNT(*) FROM dim_game g "
        f"WHERE NOT EXISTS (SELECT 1 FROM dim_team WHERE team_abbr = g.{side}_team)"
        for side in ("home", "away")
    ]
)


@query("table_key_tests", relation_sql.compose_all([*_KEYS], _COMPLETE_REPORT))
def table_key_tests(spark, sf):
    """Every declared key, and the teams of games: each table is read once."""
    t = _Frames(relations(spark, sf))
    team = lambda side: lambda: t["dim_team"].select(F.col("team_abbr").alias(f"{side}_team"))
    sides = [quality.Rule("dim_game", f"dim_game_{s}_team", parent=team(s), on=(f"{s}_team",)) for s in ("home", "away")]
    return quality.run_rules(spark, t, [*_key_rules(_ALL_KEYS), *sides])


@query(
    "market_coverage",
    relation_sql.compose(
        "int_market_open_close",
        "SELECT season, COUNT(DISTINCT game_id) AS games_with_odds, COUNT(DISTINCT game_id) FILTER (opening_line IS NOT NULL) AS games_with_opening_spread, "
        "COUNT(DISTINCT game_id) FILTER (closing_line IS NOT NULL) AS games_with_closing_spread FROM int_market_open_close "
        "WHERE market_type = 'spread' AND selection = 'home' GROUP BY season ORDER BY season DESC LIMIT 5",
    ),
)
def market_coverage(spark, sf):
    return data_tests.market_coverage(_Frames(relations(spark, sf)))


@query(
    "weather_coverage",
    relation_sql.compose(
        "stg_weather_game_kickoff",
        "SELECT season, COUNT(DISTINCT game_id) AS games_total, COUNT(DISTINCT game_id) FILTER (temp_f IS NOT NULL) AS games_with_weather, "
        "COUNT(DISTINCT game_id) FILTER (weather_source_type = 'forecast') AS games_with_forecast, "
        "COUNT(DISTINCT game_id) FILTER (weather_source_type = 'historical') AS games_with_historical "
        "FROM stg_weather_game_kickoff GROUP BY season ORDER BY season DESC LIMIT 5",
    ),
)
def weather_coverage(spark, sf):
    return data_tests.weather_coverage(_Frames(relations(spark, sf)))
