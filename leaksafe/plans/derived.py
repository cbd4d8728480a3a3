"""Raw game tables derived from the test tables, so that every relation runs on data that grows with them.

Customers are teams. Customers 2k and 2k + 1 meet once in every week in which one of them
ordered; a line item is a play, a player's figures or a market snapshot of its order's game.
The text is plain SQL that DuckDB reads too, so the stated results start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.functions import geo
from leaksafe.plans.registry import table
from leaksafe.plans.staging import team
from leaksafe.sources.tables import buckets

STAMP = "CAST('2024-01-01 00:00:00' AS TIMESTAMP) AS ingestion_ts"


def raw_team(no: str) -> str:
    return f"CASE {no} WHEN 0 THEN 'OAK' WHEN 2 THEN 'SD' WHEN 3 THEN 'STL' ELSE 'C' || {no} END"


def code(no: str) -> str:
    return f"CASE {no} WHEN 0 THEN 'LV' WHEN 2 THEN 'LAC' WHEN 3 THEN 'LA' ELSE 'C' || {no} END"


ZONES = ("America/New_York", "America/Denver", "Europe/London", "Asia/Kolkata", "Asia/Tokyo")


def zone(no: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{z}'" for i, z in enumerate(ZONES))
    return f"CASE {no} % 5 {arms} END"


# Name → SQL. `{x}` names an earlier entry or a test table.
SQL: dict[str, str] = {}

SQL["placed"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, cents, pair, season, week, played,
       'G' || pair || '_' || season || '_' || week AS game_id, pair * 2 + week % 2 AS home_no, pair * 2 + 1 - week % 2 AS away_no
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
             CAST(floor(o_custkey / 2) AS BIGINT) AS pair, CAST(year(o_orderdate) + 20 AS INT) AS season,
             CAST(floor((dayofyear(o_orderdate) - 1) / 7) + 1 AS INT) AS week, o_orderdate + INTERVAL 240 MONTH AS played
      FROM {orders}) t
"""

SQL["held"] = """
SELECT game_id, season, week, home_no, away_no, CAST(MIN(played) AS DATE) AS gameday, MIN(o_orderkey) AS k,
       SUM(CASE WHEN o_custkey = home_no THEN cents ELSE 0 END) AS home_cents,
       SUM(CASE WHEN o_custkey = away_no THEN cents ELSE 0 END) AS away_cents,
       SUM(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END) AS settled
FROM {placed} GROUP BY game_id, season, week, home_no, away_no
"""

SQL["raw_schedules"] = f"""
SELECT game_id, 'old-' || game_id AS old_game_id, season, week,
  CASE WHEN week <= 2 THEN 'PRE' WHEN week <= 46 THEN 'REG' WHEN week = 47 THEN 'WC' WHEN week = 48 THEN 'DIV' WHEN week = 49 THEN 'CON' ELSE 'SB' END AS game_type,
  gameday, CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(12 + k % 10 AS STRING) || ':' || lpad(CAST((k % 4) * 15 AS STRING), 2, '0') END AS gametime,
  CASE k % 4 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Thursday' WHEN 2 THEN 'Sunday' ELSE 'Saturday' END AS weekday,
  {raw_team('home_no')} AS home_team, {raw_team('away_no')} AS away_team,
  CASE WHEN settled = 0 THEN 'NA' ELSE CAST(CAST(floor(home_cents / 100000) AS BIGINT) % 45 AS STRING) END AS home_score,
  CASE WHEN settled = 0 THEN 'NA' ELSE CAST(CAST(floor(away_cents / 100000) AS BIGINT) % 45 AS STRING) END AS away_score,
  CASE WHEN k % 20 = 0 THEN 'Neutral' ELSE 'Home' END AS location, 'Stadium ' || home_no AS stadium, 'ST' || home_no AS stadium_id,
  CASE k % 3 WHEN 0 THEN 'grass' WHEN 1 THEN 'turf' END AS surface, CASE k % 4 WHEN 0 THEN 'closed' WHEN 1 THEN 'open' WHEN 2 THEN 'outdoors' END AS roof,
  CASE WHEN k % 5 = 0 THEN NULL WHEN k % 3 = 0 THEN 1 ELSE 0 END AS div_game, CASE WHEN k % 9 = 0 THEN NULL ELSE 7 END AS away_rest, 6 AS home_rest,
  (k % 29) / 2e0 - 7 AS spread_line, 38 + (k % 27) / 2e0 AS total_line, -110 - k % 90 AS away_moneyline, 120 + k % 70 AS home_moneyline,
  'p' || k AS pfr, 'f' || k AS pff, 'e' || k AS espn, 'd' || k AS nfl_detail_id
FROM {{held}}
"""

SQL["lines"] = """
SELECT p.game_id, p.season, p.week, p.home_no, p.away_no, p.o_custkey AS no, p.home_no + p.away_no - p.o_custkey AS other_no,
       l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate
FROM {lineitem} l JOIN {placed} p ON l.l_orderkey = p.o_orderkey
"""

SQL["raw_pbp"] = f"""
SELECT game_id, l_partkey % 10000 * 100000 + l_suppkey % 100 * 1000 + CAST(l_quantity AS BIGINT) * 10 + l_linenumber AS play_id, season, week, CAST(NULL AS STRING) AS game_date, 1 + l_partkey % 4 AS qtr,
  CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_partkey % 5 END AS down, {raw_team('no')} AS posteam, {raw_team('other_no')} AS defteam,
  {raw_team('home_no')} AS home_team, {raw_team('away_no')} AS away_team, l_partkey % 12 AS ydstogo, l_partkey % 40 AS yardline_100,
  l_suppkey % 30 AS posteam_score, l_suppkey % 25 AS defteam_score, (l_suppkey % 30 - l_suppkey % 25) * 1e0 AS score_differential,
  l_partkey % 3600 * 1e0 AS game_seconds_remaining, l_partkey % 1800 * 1e0 AS half_seconds_remaining, l_partkey % 900 * 1e0 AS quarter_seconds_remaining,
  3 AS posteam_timeouts_remaining, 2 AS defteam_timeouts_remaining,
  CASE l_linenumber WHEN 1 THEN 'pass' WHEN 2 THEN 'run' WHEN 3 THEN 'pass' WHEN 4 THEN 'run' WHEN 5 THEN 'no_play' WHEN 6 THEN 'kickoff' END AS play_type,
  CASE WHEN l_linenumber IN (1, 3) THEN 1 ELSE 0 END AS pass_attempt, CASE WHEN l_linenumber IN (2, 4) THEN 1 ELSE 0 END AS rush_attempt,
  CASE WHEN l_linenumber = 1 AND l_partkey % 9 = 0 THEN 1 ELSE 0 END AS sack, 0 AS qb_scramble, 0 AS qb_spike, 0 AS qb_kneel, l_partkey % 2 AS penalty, 0 AS punt_attempt,
  0 AS field_goal_attempt, 0 AS two_point_attempt, 0 AS extra_point_attempt, l_suppkey % 2 AS shotgun, 0 AS no_huddle,
  cos(l_partkey) * 20 AS air_yards, abs(sin(l_suppkey)) * 9 AS yards_after_catch, l_quantity - 25 + sin(l_partkey) AS yards_gained,
  sin(l_extendedprice) * 3 AS epa, cos(l_extendedprice) / 10 AS wpa, sin(l_quantity) AS air_epa, cos(l_quantity) AS yac_epa, sin(l_partkey) AS comp_air_epa,
  cos(l_partkey) AS comp_yac_epa, CASE WHEN sin(l_extendedprice) > 0 THEN 1 ELSE 0 END AS success, l_partkey % 2 AS complete_pass, 1 - l_partkey % 2 AS incomplete_pass,
  CASE WHEN l_linenumber = 3 AND l_suppkey % 8 = 0 THEN 1 WHEN l_suppkey % 11 = 0 THEN NULL ELSE 0 END AS interception,
  CASE WHEN l_partkey % 6 = 0 THEN 1 ELSE 0 END AS touchdown, 0 AS fumble, CASE WHEN l_partkey % 13 = 0 THEN 1 ELSE 0 END AS fumble_lost,
  'P' || no || '_0' AS passer_id, 'Passer' AS passer, 'P' || no || '_1' AS rusher_id, 'Rusher' AS rusher, 'P' || no || '_2' AS receiver_id, 'Receiver' AS receiver,
  CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 1 + l_suppkey % 3 * 2 + CASE WHEN no = home_no THEN 0 ELSE 1 END END AS fixed_drive, CASE l_suppkey % 3 WHEN 0 THEN 'Punt' WHEN 1 THEN 'Touchdown' ELSE 'Field goal' END AS fixed_drive_result,
  0 AS special_teams_play, CAST(NULL AS STRING) AS st_play_type, CASE WHEN l_suppkey % 50 = 0 THEN NULL WHEN week <= 46 THEN 'REG' ELSE 'POST' END AS season_type, {STAMP}
FROM {{lines}}
"""

SQL["player_weeks"] = f"""
SELECT 'P' || no || '_' || slot AS player_id, 'Player ' || no % 1000 || '-' || slot % 3 AS name, slot,
  CASE slot WHEN 0 THEN 'qb' WHEN 1 THEN 'rb' WHEN 2 THEN 'wr' WHEN 3 THEN 'te' ELSE 'cb' END AS position, no, {code('no')} AS team, {code('other_no')} AS opponent,
  season, week, CASE WHEN week <= 2 THEN 'PRE' WHEN week <= 46 THEN 'REG' ELSE 'POST' END AS season_type, n, q, x
FROM (SELECT no, other_no, season, week, l_linenumber % 5 AS slot, COUNT(*) AS n, CAST(SUM(l_quantity) AS BIGINT) AS q, MIN(l_partkey) AS x
      FROM {{lines}} GROUP BY no, other_no, season, week, l_linenumber % 5) t
"""

SQL["raw_player_stats"] = f"""
SELECT player_id, name AS player_display_name, position, position AS position_group, team, opponent AS opponent_team, season, week, season_type,
  q % 30 AS completions, CASE WHEN x % 7 = 0 THEN NULL ELSE q % 30 + n END AS attempts, 150 + 100 * sin(x) AS passing_yards, x % 4 AS passing_tds, x % 3 AS passing_interceptions,
  x % 5 AS sacks_suffered, 5 * cos(x) AS sack_yards_lost, 0 AS sack_fumbles, 0 AS sack_fumbles_lost, 90 * cos(x) AS passing_air_yards, 60 + sin(q) AS passing_yards_after_catch,
  10 * sin(x + q) AS passing_epa, CASE WHEN x % 3 = 0 THEN NULL ELSE 2 * cos(q) END AS passing_cpoe, CASE WHEN x % 6 = 0 THEN 0 ELSE q % 20 END AS carries, 40 + 30 * sin(q) AS rushing_yards, q % 2 AS rushing_tds,
  0 AS rushing_fumbles, 0 AS rushing_fumbles_lost, x % 6 AS rushing_first_downs, 3 * sin(q) AS rushing_epa, q % 11 AS targets, CAST(floor((q % 11) * 0.6) AS BIGINT) AS receptions,
  50 + 45 * cos(x + q) AS receiving_yards, x % 2 AS receiving_tds, 0 AS receiving_fumbles, 0 AS receiving_fumbles_lost, 30 + 20 * sin(x) AS receiving_air_yards,
  20 + 10 * cos(q) AS receiving_yards_after_catch, x % 7 AS receiving_first_downs, 4 * cos(x) AS receiving_epa, abs(sin(q)) / 3 AS target_share, abs(cos(q)) / 3 AS air_yards_share,
  abs(sin(x)) AS wopr, abs(cos(x)) AS racr, abs(sin(x + 1)) AS pacr, 12 + 8 * sin(x) AS fantasy_points, 15 + 9 * cos(x + n) AS fantasy_points_ppr, {STAMP}
FROM {{player_weeks}}
"""

SQL["raw_players"] = f"""
SELECT player_id AS gsis_id, MIN(name) AS display_name, 'First' AS first_name, 'Last' || MIN(no) AS last_name, MIN(position) AS position, CAST('1990-01-01' AS DATE) AS birth_date,
  'College ' || MIN(no) % 20 AS college_name, CAST(70 + MIN(x) % 10 AS INT) AS height, CAST(200 + MIN(x) % 90 AS INT) AS weight, MIN(season) AS draft_year, MIN(season) + 1 AS rookie_season,
  MIN(team) AS draft_team, CAST(1 + MIN(x) % 250 AS INT) AS draft_pick, CASE WHEN MAX(season) >= 2020 THEN 'ACT' ELSE 'RET' END AS status, 'http://img/' || player_id AS headshot,
  'F.Last' AS short_name, {STAMP}
FROM {{player_weeks}} GROUP BY player_id
"""

SQL["raw_rosters"] = f"SELECT season, {raw_team('no')} AS team, player_id FROM {{player_weeks}} GROUP BY season, no, player_id"

SQL["raw_rosters_weekly"] = f"""
SELECT season, week, {raw_team('no')} AS team, player_id AS gsis_id, name AS full_name, position, position AS depth_chart_position, 'ACT' AS status,
  CAST(x % 99 AS INT) AS jersey_number, CAST(x % 15 AS INT) AS years_exp, {STAMP}
FROM {{player_weeks}}
"""

SQL["raw_depth_charts"] = f"""
SELECT season, week, {raw_team('no')} AS club_code, player_id AS gsis_id, position, 1 + x % 3 AS depth_team, CASE WHEN slot < 4 THEN 'Offense' ELSE 'Defense' END AS formation
FROM {{player_weeks}}
"""

SQL["raw_injuries"] = f"""
SELECT season, week, {raw_team('no')} AS team, 'P' || no || '_' || l_linenumber % 5 AS gsis_id, 'Player' AS full_name,
  CASE l_partkey % 9 WHEN 0 THEN 'qb' WHEN 1 THEN 'hb' WHEN 2 THEN 'wr' WHEN 3 THEN 'te' WHEN 4 THEN 'g' WHEN 5 THEN 'dt' WHEN 6 THEN 'olb' WHEN 7 THEN 'cb' ELSE 'fs' END AS position,
  'Knee' AS report_primary_injury, CAST(NULL AS STRING) AS report_secondary_injury,
  CASE l_suppkey % 6 WHEN 0 THEN 'Out' WHEN 1 THEN 'Doubtful' WHEN 2 THEN 'Questionable' WHEN 3 THEN 'Limited' WHEN 4 THEN 'Full' END AS report_status,
  'Knee' AS practice_primary_injury, CAST(NULL AS STRING) AS practice_secondary_injury, 'DNP' AS practice_status, l_shipdate + INTERVAL 240 MONTH AS date_modified, {STAMP}
FROM {{lines}} WHERE l_returnflag = 'R'
"""

SQL["raw_snap_counts"] = f"""
SELECT season, week, 'S' || player_id AS pfr_player_id, name AS player, position, {raw_team('no')} AS team, opponent, q % 70 AS offense_snaps, abs(sin(q)) AS offense_pct,
  x % 60 AS defense_snaps, abs(cos(x)) AS defense_pct, n AS st_snaps, abs(sin(n)) AS st_pct, {STAMP}
FROM {{player_weeks}} WHERE x % 8 != 0
"""

SQL["raw_nextgen_stats"] = f"""
SELECT season, week, player_id AS player_gsis_id, name AS player_display_name, position AS player_position, {raw_team('no')} AS team_abbr, 'receiving' AS stat_type, season_type,
  3 + sin(x) AS avg_cushion, 2 + cos(x) AS avg_expected_yac, 8 + sin(q) AS avg_intended_air_yards, 3 + cos(q) AS avg_separation, 4 + sin(x + q) AS avg_yac, sin(x - q) AS avg_yac_above_expectation,
  60 + 10 * sin(q) AS catch_percentage, 20 + 5 * cos(q) AS percent_share_of_intended_air_yards, x % 2 AS rec_touchdowns, q % 9 AS receptions, q % 13 AS targets, 40 + 30 * sin(x) AS yards, {STAMP}
FROM {{player_weeks}} WHERE slot IN (0, 2, 3)
"""


def _snapshots(kind: str, selection: str, line: str, total: str, where: str = "1 = 1") -> str:
    return f"""
SELECT 'src' || l_partkey % 2 AS source_name, 'book' || l_suppkey % 9 AS sportsbook, 'E' || t.game_id AS event_id, CASE WHEN l_suppkey % 9 = 8 THEN NULL ELSE t.game_id END AS game_id,
  t.season, t.week, CAST(g.gameday AS TIMESTAMP) + (1200 - (l_partkey * 7 + CAST(l_quantity AS BIGINT) * 60 + l_suppkey) % 12000) * INTERVAL '1' MINUTE AS market_timestamp,
  CAST(g.gameday AS TIMESTAMP) + 1200 * INTERVAL '1' MINUTE AS game_datetime, {raw_team('t.home_no')} AS home_team, {raw_team('t.away_no')} AS away_team,
  '{kind}' AS market_type, '{selection}' AS selection, CASE WHEN l_linenumber <= 2 THEN 'Opening' WHEN l_linenumber <= 5 THEN 'Intraday' ELSE 'Closing' END AS snapshot_type,
  {line} AS line, CASE WHEN l_partkey % 3 = 0 THEN 100 + l_partkey % 60 ELSE -105 - l_suppkey % 30 END AS price, {total} AS overunder_line
FROM {{lines}} t JOIN {{held}} g ON t.game_id = g.game_id WHERE {where}"""


SQL["raw_market_odds_snapshot"] = f"""
SELECT source_name, sportsbook, event_id, game_id, season, week, market_timestamp, game_datetime, home_team, away_team, market_type, selection, snapshot_type, line, price AS price_american,
  CASE WHEN price >= 100 THEN price / 100e0 + 1 ELSE -100e0 / price + 1 END AS price_decimal, CASE WHEN price >= 100 THEN 100e0 / (price + 100) ELSE -price / (100e0 - price) END AS implied_probability_raw,
  overunder_line, {STAMP}
FROM (
  SELECT source_name, sportsbook, event_id, game_id, season, week, market_timestamp, game_datetime, home_team, away_team, market_type, selection, MIN(snapshot_type) AS snapshot_type,
    MIN(line) AS line, MIN(price) AS price, MIN(overunder_line) AS overunder_line
  FROM ({_snapshots('Spread', 'Home', '(l_quantity - 25) / 2e0', 'CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 40 + l_quantity / 5e0 END')}
    UNION ALL {_snapshots('Spread', 'Away', '(25 - l_quantity) / 2e0', 'CAST(NULL AS DOUBLE)', 'l_suppkey % 2 = 0')}
    UNION ALL {_snapshots('Total', 'Over', '30 + l_quantity * 1e0', 'CAST(NULL AS DOUBLE)')}
    UNION ALL {_snapshots('Moneyline', 'Home', '100 + l_quantity * 1e0', 'CAST(NULL AS DOUBLE)')}) u
  GROUP BY source_name, sportsbook, event_id, game_id, season, week, market_timestamp, game_datetime, home_team, away_team, market_type, selection) v
"""


def _weather(kind: str, run: str) -> str:
    return f"""
SELECT 'meteo' AS source_name, 'ST' || home_no AS stadium_id, home_no % 60 * 1e0 AS latitude, home_no % 120 * -1e0 AS longitude, '{kind}' AS weather_type,
  CAST(gameday AS TIMESTAMP) + h * INTERVAL '1' HOUR AS observation_or_forecast_ts, {run} AS forecast_run_ts, gameday AS game_date, season,
  CASE WHEN k % 6 = 0 THEN NULL ELSE 50 + 40 * sin(k + h) END AS temperature_2m, 48 + 40 * sin(k + h) AS apparent_temperature, abs(sin(k * 3)) * 2 AS precipitation, abs(sin(k * 3)) AS rain,
  CASE WHEN k % 8 = 0 THEN abs(cos(k)) ELSE 0e0 END AS snowfall, 0e0 AS snow_depth, CASE WHEN k % 10 = 0 THEN NULL ELSE abs(sin(k * 2 + h)) * 28 END AS wind_speed_10m,
  abs(sin(k * 2 + h)) * 35 AS wind_gusts_10m, k % 360 AS wind_direction_10m, 50 + 45 * sin(k) AS relative_humidity_2m, 40 + 10 * cos(k) AS dew_point_2m, 1000 + 20 * sin(h) AS surface_pressure,
  CAST((k * 7 + h) % 100 AS INT) AS weather_code, {STAMP}
FROM (SELECT *, 16 AS h FROM {{held}} UNION ALL SELECT *, 19 AS h FROM {{held}} UNION ALL SELECT *, 22 AS h FROM {{held}}) t
"""


SQL["raw_weather_hourly_history"] = _weather("historical", "CAST(NULL AS TIMESTAMP)")
SQL["raw_weather_forecast_hourly"] = _weather("forecast", "CAST(gameday AS TIMESTAMP) - INTERVAL '30' HOUR")

SQL["raw_stadium_metadata"] = f"""
SELECT 'ST' || c_custkey AS stadium_id, 'Stadium ' || c_custkey AS stadium_name, {code('c_custkey')} AS team, season_start, season_end,
  c_custkey * 7 % 100 - 50e0 AS latitude, c_custkey * 13 % 300 - 150e0 AS longitude, c_custkey % 30 * 100e0 AS elevation_m, CASE roof WHEN 0 THEN 'Open' WHEN 1 THEN 'Dome' ELSE 'Retractable' END AS roof_type,
  CASE c_custkey % 2 WHEN 0 THEN 'Grass' ELSE 'Turf' END AS surface_type, {zone('c_custkey')} AS timezone, CAST(50000 + c_custkey % 30 * 1000 AS INT) AS capacity, 0 AS is_neutral_site_default,
  CASE WHEN c_custkey % 40 = 0 THEN 1 ELSE 0 END AS international_game_flag, CASE WHEN c_custkey % 30 >= 15 THEN 1 ELSE 0 END AS altitude_flag, {STAMP}
FROM (SELECT c_custkey, 1990 AS season_start, 2016 AS season_end, c_custkey % 3 AS roof FROM {{customer}}
      UNION ALL SELECT c_custkey, 2017, 9999, (c_custkey + 1) % 3 FROM {{customer}}) t WHERE c_custkey % 11 != 0
"""

SQL["raw_coach_reference"] = f"""
SELECT {raw_team('o_custkey')} AS team, season, 'Coach ' || o_custkey AS coach_name, 'hc' AS coach_role, MIN(season) AS first_season_with_team, 0 AS is_rookie_hc, 0 AS coordinator_change_flag, {STAMP}
FROM {{placed}} GROUP BY o_custkey, season
"""

# The same rows as `raw_market_odds_snapshot`, from one exchange of the lines. All four markets of a line have the same key: the game,
# two remainders and the minutes before its start. So lines are grouped once, by that key as numbers, and become rows of
# markets afterwards. What depends on the game alone comes from the game.
ODDS_GROUPS = """
SELECT g.game_id, season, week, home_no, away_no, gameday, src, book, back, MIN(stage) AS stage, MIN(line) AS spread, MIN(price) AS price, MIN(overunder) AS overunder,
  MIN(over) AS over, MIN(money) AS money, COUNT(IF(even, 1, NULL)) AS n_even, MIN(IF(even, stage, NULL)) AS even_stage, MIN(IF(even, price, NULL)) AS even_price, MIN(IF(even, away, NULL)) AS away
FROM (
  SELECT game_id, CAST(l_partkey % 2 AS INT) AS src, CAST(l_suppkey % 9 AS INT) AS book, CAST((l_partkey * 7 + CAST(l_quantity AS BIGINT) * 60 + l_suppkey) % 12000 AS INT) AS back,
    CASE WHEN l_linenumber <= 2 THEN 2 WHEN l_linenumber <= 5 THEN 1 ELSE 0 END AS stage, COALESCE(l_suppkey % 2 = 0, FALSE) AS even,
    CAST(CASE WHEN l_partkey % 3 = 0 THEN 100 + l_partkey % 60 ELSE -105 - l_suppkey % 30 END AS INT) AS price,
    (l_quantity - 25) / 2e0 AS line, (25 - l_quantity) / 2e0 AS away, 30 + l_quantity * 1e0 AS over, 100 + l_quantity * 1e0 AS money,
    CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 40 + l_quantity / 5e0 END AS overunder
  FROM {lines}) t JOIN {held} g ON t.game_id = g.game_id
GROUP BY g.game_id, season, week, home_no, away_no, gameday, src, book, back
"""

ODDS_ROWS = f"""
SELECT source_name, sportsbook, event_id, game_id, season, week, market_timestamp, game_datetime, home_team, away_team, market_type, selection, snapshot_type, line, price AS price_american,
  CASE WHEN price >= 100 THEN price / 100e0 + 1 ELSE -100e0 / price + 1 END AS price_decimal, CASE WHEN price >= 100 THEN 100e0 / (price + 100) ELSE -price / (100e0 - price) END AS implied_probability_raw,
  overunder_line, {STAMP}
FROM (
  SELECT 'src' || src AS source_name, 'book' || book AS sportsbook, 'E' || game_id AS event_id, CASE WHEN book = 8 THEN NULL ELSE game_id END AS game_id, season, week,
    CAST(gameday AS TIMESTAMP) + (1200 - back) * INTERVAL '1' MINUTE AS market_timestamp, CAST(gameday AS TIMESTAMP) + 1200 * INTERVAL '1' MINUTE AS game_datetime,
    {raw_team('home_no')} AS home_team, {raw_team('away_no')} AS away_team, m.market_type, m.selection,
    CASE m.stage WHEN 2 THEN 'Opening' WHEN 1 THEN 'Intraday' ELSE 'Closing' END AS snapshot_type, m.line, CAST(m.price AS BIGINT) AS price, m.overunder_line
  FROM {{groups}} LATERAL VIEW explode(array(
    named_struct('n', 1L, 'market_type', 'Spread', 'selection', 'Home', 'stage', stage, 'line', spread, 'price', price, 'overunder_line', overunder),
    named_struct('n', n_even, 'market_type', 'Spread', 'selection', 'Away', 'stage', even_stage, 'line', away, 'price', even_price, 'overunder_line', CAST(NULL AS DOUBLE)),
    named_struct('n', 1L, 'market_type', 'Total', 'selection', 'Over', 'stage', stage, 'line', over, 'price', price, 'overunder_line', CAST(NULL AS DOUBLE)),
    named_struct('n', 1L, 'market_type', 'Moneyline', 'selection', 'Home', 'stage', stage, 'line', money, 'price', price, 'overunder_line', CAST(NULL AS DOUBLE)))) v AS m
  WHERE m.n > 0) r
"""

# The same rows as `lines`: what follows from a game's pair, season and week is made after the exchange by game, not carried through it.
GAME_ID = "'G' || pair || '_' || season || '_' || week"
LINES_PLACED = """
SELECT p.pair, p.season, p.week, p.o_custkey AS no, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate
FROM {lineitem} l JOIN {placed} p ON l.l_orderkey = p.o_orderkey
"""
LINES_ROWS = f"""
SELECT game_id, season, week, home_no, away_no, no, home_no + away_no - no AS other_no, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_shipdate
FROM (SELECT *, {GAME_ID} AS game_id, pair * 2 + week % 2 AS home_no, pair * 2 + 1 - week % 2 AS away_no FROM {{dealt}}) t
"""

# The same rows as `player_weeks`: a team's game follows from its number, season and week, so lines are grouped where they lie.
PLAYER_WEEKS = SQL["player_weeks"].replace("GROUP BY no,", "GROUP BY game_id, no,")

# The two tables the library computes itself: zones per team and season, and travel.
ORACLE_ONLY = {
    "raw_team_timezone_reference": """
SELECT team, CAST(UNNEST(range(GREATEST(season_start, first_season), LEAST(season_end, last_season) + 1)) AS INTEGER) AS season, stadium_id, timezone AS home_timezone,
  latitude, longitude FROM {raw_stadium_metadata}, (SELECT MIN(season) AS first_season, MAX(season) AS last_season FROM {placed}) s
""",
    "trips": """
SELECT DISTINCT g.season, g.home, g.away, h.latitude AS lat2, h.longitude AS lon2, h.home_timezone AS tz2, a.latitude AS lat1, a.longitude AS lon1, a.home_timezone AS tz1
FROM (SELECT season, HOME_CODE AS home, AWAY_CODE AS away FROM {held}) g
LEFT JOIN {raw_team_timezone_reference} h ON h.team = g.home AND h.season = g.season LEFT JOIN {raw_team_timezone_reference} a ON a.team = g.away AND a.season = g.season
""".replace("HOME_CODE", code("home_no")).replace("AWAY_CODE", code("away_no")),
    "raw_team_travel_reference": """
SELECT season, home AS home_team, away AS away_team, 2 * 6371 * atan2(sqrt(v), sqrt(1 - v)) AS travel_km, z2 - z1 AS timezone_shift_hours,
  CASE WHEN z2 - z1 < -1 THEN 1 ELSE 0 END AS east_to_west_flag, CASE WHEN z2 - z1 > 1 THEN 1 ELSE 0 END AS west_to_east_flag,
  CASE WHEN abs(lat2 - lat1) > 20 OR abs(lon2 - lon1) > 50 THEN 1 ELSE 0 END AS international_travel_flag, STAMP
FROM (SELECT *, pow(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2) AS v,
        OFFSET1 AS z1, OFFSET2 AS z2 FROM {trips}) t
""".replace("STAMP", STAMP).replace("OFFSET1", "CASE tz1 WHEN 'America/New_York' THEN -4e0 WHEN 'America/Denver' THEN -6e0 WHEN 'Europe/London' THEN 0e0 WHEN 'Asia/Kolkata' THEN 5.5e0 WHEN 'Asia/Tokyo' THEN 9e0 END").replace("OFFSET2", "CASE tz2 WHEN 'America/New_York' THEN -4e0 WHEN 'America/Denver' THEN -6e0 WHEN 'Europe/London' THEN 0e0 WHEN 'Asia/Kolkata' THEN 5.5e0 WHEN 'Asia/Tokyo' THEN 9e0 END"),
}

TABLES = ("orders", "lineitem", "customer")


def needs(sql: str) -> list[str]:
    """Names in braces."""
    import string

    return list(dict.fromkeys(f for _, f, _, _ in string.Formatter().parse(sql) if f))


# Joined and grouped once, read by most raw tables.
SHARED = ("held", "lines", "player_weeks")
# Written in buckets by these columns: what groups or joins a game's rows afterwards finds them in one place.
DEALT = {"held": ("game_id",), "lines": ("game_id",)}


COMPUTED = ("raw_team_timezone_reference", "raw_team_travel_reference")


def is_raw(name: str) -> bool:
    return name in TABLES or name in SQL or name in COMPUTED


def raw_frame(spark: SparkSession, folder: str, name: str, get) -> DataFrame:
    """One raw table as a lazy frame; `get(name)` yields the tables it needs."""
    if name in TABLES:
        return table(spark, folder, name)
    if name == "held":  # dealt before they are grouped: one exchange does for both
        return spark.sql(SQL[name], placed=get("placed").repartition(buckets(spark), *DEALT[name]))
    if name == "lines":
        placed = spark.sql(LINES_PLACED, **{n: get(n) for n in needs(LINES_PLACED)})
        return spark.sql(LINES_ROWS, dealt=placed.repartition(buckets(spark), F.expr(GAME_ID)))
    if name == "player_weeks":
        return spark.sql(PLAYER_WEEKS, lines=get("lines"))
    if name == "raw_market_odds_snapshot":
        groups = spark.sql(ODDS_GROUPS, lines=get("lines"), held=get("held"))
        return spark.sql(ODDS_ROWS, groups=groups)
    if name in SQL:
        return spark.sql(SQL[name], **{n: get(n) for n in needs(SQL[name])})
    # The seasons there are: one row of two numbers.
    first, last = get("placed").agg(F.min("season"), F.max("season")).first()
    zones = geo.expand_validity(get("raw_stadium_metadata"), "season_start", "season_end", first or 0, last or 0)
    if name == "raw_team_timezone_reference":
        return zones.select("team", "season", "stadium_id", F.col("timezone").alias("home_timezone"), "latitude", "longitude")
    pairs = get("raw_schedules").select("season", team("home_team").alias("home_team"), team("away_team").alias("away_team"))
    travel = geo.pair_distances(pairs, zones.select("team", "season", "latitude", "longitude", "timezone"))
    return travel.withColumn("ingestion_ts", F.lit("2024-01-01").cast("timestamp"))
