"""What each relation must return, as SQL over the derived raw tables; used by `oracle_sql()`."""

from __future__ import annotations

from leaksafe.plans import derived
from leaksafe.plans import oracle_columns as named
from leaksafe.plans.staging import NOT_A_PLAY, POSITION_GROUPS, SPREAD_KEYS, TOTAL_KEYS, WEATHER_CODES

SQL: dict[str, str] = {}


def cast(names: str, dtype: str, default: str | None = None) -> str:
    """'source:output …' cast to one type."""
    out = []
    for part in names.split():
        source, _, name = part.partition(":")
        value = f"CAST({source} AS {dtype})"
        out.append(f"{value if default is None else f'COALESCE({value}, {default})'} AS {name or source}")
    return ", ".join(out)


def plain(names: str, alias: str = "") -> str:
    out = []
    for part in names.split():
        source, _, name = part.partition(":")
        out.append(f"{alias}{source} AS {name or source}")
    return ", ".join(out)


def canon(col: str) -> str:
    return f"CASE {col} WHEN 'OAK' THEN 'LV' WHEN 'SD' THEN 'LAC' WHEN 'STL' THEN 'LA' ELSE {col} END"


def one(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"


def lookup(col: str, mapping: dict, other: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + f" ELSE '{other}' END"


def nearest_key(expr: str, keys) -> str:
    return "LEAST(" + ", ".join(f"abs({expr} - {k})" for k in keys) + ")"


SEVERITY = "CASE upper(report_status) WHEN 'OUT' THEN 4 WHEN 'DOUBTFUL' THEN 3 WHEN 'QUESTIONABLE' THEN 2 WHEN 'LIMITED' THEN 1 ELSE 0 END"
SKIPPED = ", ".join(f"'{p}'" for p in NOT_A_PLAY)

# --- staging -----------------------------------------------------------------------------------

SQL["stg_games"] = f"""
SELECT game_id, old_game_id, {cast('season week', 'INTEGER')}, game_type,
  CASE WHEN game_type = 'REG' THEN 'regular' WHEN game_type IN ('WC', 'DIV', 'CON', 'SB') THEN 'postseason' ELSE 'unknown' END AS season_type,
  gameday AS game_date, gametime AS kickoff_time_local, weekday, {canon('home_team')} AS home_team, {canon('away_team')} AS away_team, hs AS home_score, aws AS away_score,
  hs + aws AS total_points, hs - aws AS home_margin, CASE WHEN hs > aws THEN 1 WHEN hs < aws THEN 0 END AS home_win_flag, {one('hs IS NOT NULL')} AS game_completed_flag,
  location, stadium, stadium_id, upper(COALESCE(surface, 'unknown')) AS surface, upper(COALESCE(roof, 'unknown')) AS roof, COALESCE(div_game, 0) AS div_game, COALESCE(div_game, 0) AS conf_game,
  {one("upper(weekday) IN ('MONDAY', 'THURSDAY') OR upper(weekday) = 'SUNDAY' AND CAST(split_part(COALESCE(gametime, '13:00'), ':', 1) AS INTEGER) >= 20")} AS primetime_flag,
  COALESCE(away_rest, 7) AS away_rest_days, COALESCE(home_rest, 7) AS home_rest_days,
  {cast('spread_line:schedule_spread_line total_line:schedule_total_line away_moneyline:schedule_away_ml home_moneyline:schedule_home_ml', 'DOUBLE')},
  pfr AS pfr_game_id, pff AS pff_game_id, espn AS espn_game_id, nfl_detail_id
FROM (SELECT *, TRY_CAST(home_score AS INTEGER) AS hs, TRY_CAST(away_score AS INTEGER) AS aws FROM {{raw_schedules}} WHERE game_type != 'PRE') t
"""

SQL["stg_plays"] = f"""
SELECT game_id, {cast('play_id season week', 'INTEGER')}, game_date, {cast('qtr:quarter down', 'INTEGER')}, {canon('posteam')} AS posteam, {canon('defteam')} AS defteam,
  {canon('home_team')} AS home_team, {canon('away_team')} AS away_team, {cast('ydstogo yardline_100 posteam_score defteam_score', 'INTEGER')},
  {cast('score_differential game_seconds_remaining half_seconds_remaining quarter_seconds_remaining:qtr_seconds_remaining', 'DOUBLE')},
  {cast('posteam_timeouts_remaining:posteam_timeouts defteam_timeouts_remaining:defteam_timeouts qb_scramble:scramble', 'INTEGER')}, play_type,
  {cast('pass_attempt rush_attempt sack qb_spike qb_kneel penalty punt_attempt field_goal_attempt two_point_attempt extra_point_attempt shotgun no_huddle success complete_pass incomplete_pass interception touchdown fumble fumble_lost special_teams_play', 'INTEGER')},
  air_yards, yards_after_catch, yards_gained, epa, wpa, air_epa, yac_epa, comp_air_epa, comp_yac_epa, passer_id, passer, rusher_id, rusher, receiver_id, receiver,
  {cast('fixed_drive:drive_id', 'INTEGER')}, fixed_drive_result AS drive_result, st_play_type, {one('yardline_100 <= 20')} AS red_zone_flag, {one('yardline_100 <= 5')} AS goal_line_flag,
  {one('half_seconds_remaining <= 120')} AS two_minute_flag, CASE season_type WHEN 'POST' THEN 'postseason' ELSE 'regular' END AS season_type
FROM {{raw_pbp}} WHERE COALESCE(play_type, '') NOT IN ({SKIPPED})
"""

SQL["stg_drives"] = f"""
SELECT game_id, {cast('fixed_drive:drive_id season', 'INTEGER')}, {canon('posteam')} AS posteam, {canon('defteam')} AS defteam, MIN(yardline_100) AS end_yardline_100, MAX(yardline_100) AS start_yardline_100,
  COUNT(*) AS plays, SUM(yards_gained) AS yards_gained,
  {', '.join(f'CAST(SUM({s}) AS BIGINT) AS {o}' for s, o in (('pass_attempt', 'pass_attempts'), ('rush_attempt', 'rush_attempts'), ('touchdown', 'touchdowns'), ('penalty', 'penalties'), ('fumble_lost', 'fumbles_lost'), ('interception', 'interceptions')))},
  MAX({one('yardline_100 <= 20')}) AS reached_red_zone, MAX(fixed_drive_result) AS drive_result
FROM {{raw_pbp}} WHERE fixed_drive IS NOT NULL AND play_type NOT IN ({SKIPPED}) GROUP BY ALL
"""

SQL["stg_teams"] = f"""
SELECT DISTINCT {canon('t')} AS team_abbr, CAST(NULL AS VARCHAR) AS team_name, CAST(NULL AS VARCHAR) AS team_conf, CAST(NULL AS VARCHAR) AS team_division
FROM (SELECT home_team AS t FROM {{raw_schedules}} UNION ALL SELECT away_team FROM {{raw_schedules}} UNION ALL SELECT team FROM {{raw_rosters}}) u WHERE t IS NOT NULL
"""

SQL["stg_players"] = f"""
SELECT gsis_id AS player_id, display_name AS full_name, first_name, last_name, upper(position) AS position, {lookup('upper(position)', POSITION_GROUPS, 'OTHER')} AS position_group, birth_date,
  college_name AS college, height, weight, draft_year AS entry_year, rookie_season AS rookie_year, draft_team AS draft_club, draft_pick AS draft_number, {one("status = 'ACT'")} AS active_flag,
  headshot AS headshot_url, short_name
FROM {{raw_players}} WHERE gsis_id IS NOT NULL
"""

SQL["stg_player_week"] = f"""
SELECT player_id, player_display_name AS full_name, upper(position) AS position, upper(position_group) AS position_group, team, opponent_team AS opponent, {cast('season week', 'INTEGER')}, season_type,
  {cast('completions attempts passing_tds sack_fumbles sack_fumbles_lost carries rushing_tds rushing_fumbles rushing_fumbles_lost rushing_first_downs targets receptions receiving_tds receiving_fumbles receiving_fumbles_lost receiving_first_downs passing_interceptions:interceptions sacks_suffered:sacks', 'INTEGER', '0')},
  {cast('passing_yards passing_air_yards passing_epa rushing_yards rushing_epa receiving_yards receiving_air_yards receiving_epa target_share air_yards_share wopr racr pacr sack_yards_lost:sack_yards passing_yards_after_catch:passing_yac passing_cpoe:dakota receiving_yards_after_catch:receiving_yac', 'DOUBLE', '0')},
  fantasy_points AS fantasy_points_std, fantasy_points_ppr
FROM {{raw_player_stats}} WHERE player_id IS NOT NULL AND season_type IN ('REG', 'POST')
"""

SQL["stg_team_week"] = f"""
SELECT game_id, season, week, game_type, gameday AS game_date, team, opponent, home_flag, pf AS points_for, pa AS points_against, pf - pa AS margin,
  CASE WHEN pf > pa THEN 1 WHEN pf < pa THEN 0 END AS win_flag, CASE WHEN game_type = 'REG' THEN 'regular' ELSE 'postseason' END AS season_type
FROM (SELECT s.*, x.home_flag, CASE x.home_flag WHEN 1 THEN h ELSE a END AS team, CASE x.home_flag WHEN 1 THEN a ELSE h END AS opponent,
        CASE x.home_flag WHEN 1 THEN hs ELSE aws END AS pf, CASE x.home_flag WHEN 1 THEN aws ELSE hs END AS pa
      FROM (SELECT *, {canon('home_team')} AS h, {canon('away_team')} AS a, TRY_CAST(home_score AS INTEGER) AS hs, TRY_CAST(away_score AS INTEGER) AS aws FROM {{raw_schedules}} WHERE game_type != 'PRE') s
      CROSS JOIN (VALUES (1), (0)) x(home_flag)) t
"""

SQL["stg_rosters_weekly"] = f"""
SELECT gsis_id AS player_id, full_name, upper(position) AS position, depth_chart_position, {canon('team')} AS team, season, week, status, jersey_number, years_exp FROM {{raw_rosters_weekly}}
"""

SQL["stg_injuries_weekly"] = f"""
SELECT gsis_id AS player_id, full_name, upper(position) AS position, {canon('team')} AS team, season, week, CAST(date_modified AS DATE) AS report_date, report_primary_injury, report_secondary_injury,
  report_status, practice_primary_injury, practice_secondary_injury, practice_status, {SEVERITY} AS injury_severity_score
FROM {{raw_injuries}}
"""

SQL["stg_snap_counts_weekly"] = f"""
SELECT pfr_player_id, player AS full_name, upper(position) AS position, {canon('team')} AS team, opponent, season, week, {cast('offense_snaps defense_snaps st_snaps', 'INTEGER')},
  {plain('offense_pct:offense_snap_pct defense_pct:defense_snap_pct st_pct:st_snap_pct')}
FROM {{raw_snap_counts}}
"""

SQL["stg_nextgen_player_week"] = f"""
SELECT player_gsis_id AS player_id, player_display_name AS full_name, upper(player_position) AS position, {canon('team_abbr')} AS team, season, week, stat_type, season_type,
  {plain('avg_cushion avg_expected_yac avg_intended_air_yards avg_separation avg_yac avg_yac_above_expectation catch_percentage yards percent_share_of_intended_air_yards:intended_air_yards_share')},
  {cast('rec_touchdowns receptions targets', 'INTEGER')}
FROM {{raw_nextgen_stats}}
"""

SQL["stg_market_game_line"] = f"""
SELECT * EXCLUDE (hs), CASE WHEN hs AND overunder_line IS NOT NULL THEN overunder_line / 2 - line / 2 END AS implied_home_team_total, CASE WHEN hs AND overunder_line IS NOT NULL THEN overunder_line / 2 + line / 2 END AS implied_away_team_total,
  {one('hs AND line < 0')} AS home_favorite_flag, {one('hs AND line > 0')} AS home_underdog_flag,
  CASE WHEN market_type = 'spread' THEN {nearest_key('abs(line)', SPREAD_KEYS)} END AS spread_key_number_distance, CASE WHEN market_type = 'total' THEN {nearest_key('line', TOTAL_KEYS)} END AS total_key_number_distance
FROM (SELECT o.source_name, o.sportsbook, o.event_id, COALESCE(o.game_id, g.game_id) AS game_id, o.season, o.week, o.market_timestamp AS market_timestamp_utc, o.game_datetime AS game_datetime_utc,
        o.home_team, o.away_team, lower(o.market_type) AS market_type, lower(o.selection) AS selection, o.line, CAST(o.price_american AS INTEGER) AS price_american, o.price_decimal,
        o.implied_probability_raw AS implied_prob_raw, o.overunder_line, lower(o.snapshot_type) AS snapshot_type, lower(o.market_type) = 'spread' AND lower(o.selection) = 'home' AS hs
      FROM {{raw_market_odds_snapshot}} o LEFT JOIN (SELECT * FROM {{raw_schedules}} WHERE game_type != 'PRE') g
        ON o.home_team = g.home_team AND o.away_team = g.away_team AND CAST(o.game_datetime AS DATE) = g.gameday AND o.season = g.season) t
"""

SQL["stg_market_consensus_game"] = """
SELECT game_id, season, week, market_timestamp_utc AS market_timestamp, market_type, selection, snapshot_type, COUNT(DISTINCT sportsbook) AS book_count, AVG(line) AS consensus_line, MIN(line) AS min_line,
  MAX(line) AS max_line, stddev_pop(line) AS line_stddev, MAX(line) - MIN(line) AS line_range, AVG(implied_prob_raw) AS avg_implied_prob
FROM {stg_market_game_line} WHERE game_id IS NOT NULL GROUP BY ALL
"""

SQL["stg_market_close_game"] = f"""
SELECT game_id, season, week, home_team, away_team, market_type, selection, market_timestamp_utc AS close_timestamp, line AS closing_line, price_american AS closing_price_american,
  price_decimal AS closing_price_decimal, implied_prob_raw AS closing_implied_prob, {plain('implied_home_team_total implied_away_team_total home_favorite_flag home_underdog_flag spread_key_number_distance total_key_number_distance')},
  sportsbook AS close_sportsbook, source_name
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, market_type, selection ORDER BY market_timestamp_utc DESC, source_name DESC, sportsbook DESC, event_id DESC) AS rn
      FROM {{stg_market_game_line}} WHERE snapshot_type = 'closing' AND game_id IS NOT NULL) t WHERE rn = 1
"""

_conditions = " ".join(f"WHEN weather_code BETWEEN {a} AND {b} THEN '{label}'" for a, b, label in WEATHER_CODES)
SQL["stg_weather_game_hourly"] = f"""
SELECT source_name, stadium_id, latitude, longitude, weather_type, observation_or_forecast_ts AS weather_ts, forecast_run_ts, game_date, season,
  {plain('temperature_2m:temp_f apparent_temperature:apparent_temp_f precipitation:precip_in rain:rain_in snowfall:snow_in snow_depth:snow_depth_in wind_speed_10m:wind_mph wind_gusts_10m:wind_gusts_mph')},
  {cast('wind_direction_10m:wind_dir_deg', 'INTEGER')}, {plain('relative_humidity_2m:humidity_pct dew_point_2m:dew_point_f surface_pressure:pressure_hpa')}, weather_code, CASE {_conditions} ELSE 'Other' END AS weather_condition
FROM (SELECT * FROM {{raw_weather_hourly_history}} UNION ALL SELECT * FROM {{raw_weather_forecast_hourly}}) t
"""

WEATHER = "temp_f apparent_temp_f precip_in rain_in snow_in snow_depth_in wind_mph wind_gusts_mph wind_dir_deg humidity_pct dew_point_f pressure_hpa weather_code weather_condition"
SQL["stg_weather_game_kickoff"] = f"""
SELECT g.game_id, g.season, g.week, g.game_date, g.kickoff_ts_approx, g.stadium_id, g.roof, g.metadata_roof_type, {plain(WEATHER, 'w.')}, w.gap AS weather_obs_minutes_from_kickoff,
  w.weather_type AS weather_source_type, w.forecast_run_ts, {one('g.shut')} AS roof_closed_flag, CASE WHEN g.shut THEN 0 ELSE 1 END AS open_air_weather_applicable
FROM kicked g LEFT JOIN (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id ORDER BY gap, weather_ts) AS rn FROM (
    SELECT k.game_id, h.*, abs(epoch(h.weather_ts) - epoch(k.kickoff_ts_approx)) / 60 AS gap FROM kicked k
    JOIN {{stg_weather_game_hourly}} h ON k.stadium_id = h.stadium_id AND k.game_date = h.game_date AND h.weather_type = 'historical') n) w ON g.game_id = w.game_id AND w.rn = 1
"""
KICKED = """
SELECT g.game_id, g.season, g.week, g.game_date, g.roof, m.stadium_id, m.roof_type AS metadata_roof_type,
  CAST(g.game_date AS TIMESTAMP) + (COALESCE(TRY_CAST(split_part(kickoff_time_local, ':', 1) AS INTEGER), 13) * 60 + COALESCE(TRY_CAST(split_part(kickoff_time_local, ':', 2) AS INTEGER), 0)) * INTERVAL '1' MINUTE AS kickoff_ts_approx,
  lower(m.roof_type) = 'dome' OR lower(m.roof_type) = 'retractable' AND lower(g.roof) IN ('closed', 'dome') AS shut
FROM {stg_games} g LEFT JOIN {raw_stadium_metadata} m ON g.home_team = m.team AND g.season BETWEEN m.season_start AND m.season_end
"""
SQL["kicked"] = KICKED
SQL["stg_weather_game_kickoff"] = SQL["stg_weather_game_kickoff"].replace("kicked g", "{kicked} g").replace("kicked k", "{kicked} k")

SQL["stg_stadium"] = f"""
SELECT stadium_id, stadium_name, {canon('team')} AS team, season_start, season_end, latitude, longitude, elevation_m, lower(roof_type) AS roof_type, lower(surface_type) AS surface_type, timezone, capacity,
  international_game_flag, altitude_flag, is_neutral_site_default AS is_neutral_site, CASE lower(roof_type) WHEN 'dome' THEN 'indoor' WHEN 'retractable' THEN 'retractable' ELSE 'outdoor' END AS venue_category
FROM {{raw_stadium_metadata}}
"""

SQL["stg_travel_context"] = """
SELECT season, home_team, away_team, travel_km, ROUND(travel_km / 1.60934::DOUBLE, 1) AS travel_miles, timezone_shift_hours, east_to_west_flag, west_to_east_flag, international_travel_flag FROM {raw_team_travel_reference}
"""

SQL["stg_coaching_context"] = f"""
SELECT {canon('team')} AS team, season, coach_name, upper(coach_role) AS coach_role, first_season_with_team, is_rookie_hc, coordinator_change_flag FROM {{raw_coach_reference}}
"""

# --- intermediate ------------------------------------------------------------------------------

SQL["spots"] = """
SELECT *, LAG(game_date) OVER w AS prev, LEAD(game_date) OVER w AS nxt, ROW_NUMBER() OVER w AS rn,
  SUM(1 - home_flag) OVER l4 AS road4, SUM(home_flag) OVER l4 AS home4, MAX(CASE WHEN home_flag = 1 THEN num END) OVER b AS last_home, MAX(CASE WHEN home_flag = 0 THEN num END) OVER b AS last_road
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY team, season ORDER BY week, game_id) AS num FROM {stg_team_week} WHERE season_type = 'regular') t
WINDOW w AS (PARTITION BY team, season ORDER BY week, game_id), l4 AS (PARTITION BY team, season ORDER BY week, game_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW),
  b AS (PARTITION BY team, season ORDER BY week, game_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
"""

SQL["int_game_base"] = f"""
SELECT g.game_id, g.season, g.week, g.season_type, g.game_date, g.kickoff_time_local, g.weekday, g.home_team, g.away_team, g.home_score, g.away_score, g.total_points, g.home_margin, g.home_win_flag,
  g.game_completed_flag, g.stadium, g.surface, g.roof, g.location, g.div_game, g.conf_game, g.primetime_flag, h.rest AS home_rest_days, h.opener AS home_bye_prior, h.short AS home_short_week,
  a.rest AS away_rest_days, a.opener AS away_bye_prior, a.short AS away_short_week, COALESCE(h.rest, 7) - COALESCE(a.rest, 7) AS rest_days_advantage_home, g.pfr_game_id, g.espn_game_id, g.nfl_detail_id
FROM {{stg_games}} g LEFT JOIN {{rested}} h ON g.game_id = h.game_id AND h.home_flag = 1 LEFT JOIN {{rested}} a ON g.game_id = a.game_id AND a.home_flag = 0
"""
SQL["rested"] = f"""
SELECT game_id, home_flag, since AS rest, {one('since IS NULL')} AS opener, {one('since <= 6')} AS short FROM (SELECT *, CAST(date_diff('day', prev, game_date) AS INTEGER) AS since FROM {{spots}}) t
"""

SQL["int_team_schedule_spot"] = f"""
SELECT game_id, team, season, week, home_flag, game_date, since AS rest_days, {one('since IS NULL')} AS season_opener_flag, {one('since <= 6')} AS short_week_flag, {one('since >= 10')} AS long_rest_flag,
  {one('since IS NULL')} AS bye_week_prior_flag, CAST(GREATEST(0, road4 - 1) AS BIGINT) AS consecutive_road_games_prior, CAST(GREATEST(0, home4 - 1) AS BIGINT) AS consecutive_home_games_prior,
  num - 1 - COALESCE(last_home, 0) AS road_streak_prior, num - 1 - COALESCE(last_road, 0) AS home_streak_prior, {one('home_flag = 0 AND road4 >= 3')} AS third_road_in_four_flag, 1 - home_flag AS road_game_flag,
  CAST(date_diff('day', game_date, nxt) AS INTEGER) AS "days_until_next_game_DESCRIPTIVE_ONLY"
FROM (SELECT *, CAST(date_diff('day', prev, game_date) AS INTEGER) AS since FROM {{spots}}) t
"""

PASS, RUSH = "pass_attempt = 1", "rush_attempt = 1"


def rate(cond: str) -> str:
    return f"AVG(CASE WHEN {cond} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


LOST = "COALESCE(interception, 0) + COALESCE(fumble_lost, 0)"
SQL["scrimmage"] = "SELECT * FROM {stg_plays} WHERE play_type IN ('pass', 'run') AND season_type = 'regular'"
SQL["attack"] = f"""
SELECT game_id, posteam AS team, COUNT(*) AS offensive_plays, CAST(SUM(pass_attempt) AS BIGINT) AS pass_attempts, CAST(SUM(rush_attempt) AS BIGINT) AS rush_attempts, SUM(yards_gained) AS total_yards, AVG(epa) AS epa_per_play,
  SUM(epa) AS total_epa, AVG(epa) FILTER ({PASS}) AS pass_epa_per_dropback, AVG(epa) FILTER ({RUSH}) AS rush_epa_per_carry, AVG(success) AS success_rate, AVG(success) FILTER ({PASS}) AS pass_success_rate,
  AVG(success) FILTER ({RUSH}) AS rush_success_rate, {rate(PASS + ' AND yards_gained >= 20')} AS explosive_pass_rate, {rate(RUSH + ' AND yards_gained >= 10')} AS explosive_rush_rate,
  AVG(air_yards) FILTER ({PASS}) AS avg_air_yards, COUNT(*) FILTER (red_zone_flag = 1) AS red_zone_plays, COUNT(*) FILTER (red_zone_flag = 1 AND touchdown = 1) AS red_zone_tds,
  CAST(SUM(interception) AS BIGINT) AS interceptions_thrown, CAST(SUM(fumble_lost) AS BIGINT) AS fumbles_lost, CAST(SUM({LOST}) AS BIGINT) AS turnovers, CAST(SUM(sack) AS BIGINT) AS sacks_allowed
FROM {{scrimmage}} GROUP BY 1, 2
"""
SQL["defence"] = f"""
SELECT game_id, defteam AS team, AVG(epa) AS def_epa_per_play, SUM(epa) AS def_total_epa, AVG(success) AS def_success_rate_allowed, AVG(epa) FILTER ({PASS}) AS def_pass_epa_per_dropback,
  AVG(epa) FILTER ({RUSH}) AS def_rush_epa_per_carry, CAST(SUM({LOST}) AS BIGINT) AS def_turnovers_forced, CAST(SUM(sack) AS BIGINT) AS def_sacks, {rate(PASS + ' AND yards_gained >= 20')} AS def_explosive_pass_rate_allowed,
  COUNT(*) FILTER (red_zone_flag = 1 AND touchdown = 1) AS def_red_zone_tds_allowed
FROM {{scrimmage}} GROUP BY 1, 2
"""
SQL["int_team_game"] = """
SELECT s.* EXCLUDE (game_type), o.* EXCLUDE (game_id, team), d.* EXCLUDE (game_id, team), CASE WHEN red_zone_plays > 0 THEN red_zone_tds / red_zone_plays END AS red_zone_td_rate,
  CASE WHEN pass_attempts + rush_attempts > 0 THEN pass_attempts / (pass_attempts + rush_attempts) END AS pass_rate
FROM {stg_team_week} s LEFT JOIN {attack} o ON s.game_id = o.game_id AND s.team = o.team LEFT JOIN {defence} d ON s.game_id = d.game_id AND s.team = d.team
"""


def lagged(columns: dict, window: str) -> str:
    return ", ".join(f"AVG(CAST({c} AS DOUBLE)) OVER {window} AS {o}" for o, c in columns.items())


def frames(partition: str, **sizes: int) -> str:
    base = f"PARTITION BY {partition} ORDER BY week, game_id ROWS BETWEEN"
    out = [f"s AS ({base} UNBOUNDED PRECEDING AND 1 PRECEDING)"]
    out += [f"{name} AS ({base} {n} PRECEDING AND 1 PRECEDING)" for name, n in sizes.items()]
    return ", ".join(out)


def blended(m: str) -> str:
    return f"CASE WHEN games_played_std >= 3 THEN 0.7::DOUBLE * COALESCE({m}_std, 0) + 0.3::DOUBLE * COALESCE(prior_{m}, 0) ELSE COALESCE(prior_{m}, 0) END AS {m}_blended"


SQL["int_team_form"] = f"""
SELECT f.*, {', '.join(f'p.{c}' for c in named.PRIOR)}, {blended('epa_pp')}, {blended('def_epa_pp')}
FROM (SELECT team, season, week, game_id, game_date, points_for, points_against, margin, win_flag, ROW_NUMBER() OVER (PARTITION BY team, season ORDER BY week, game_id) AS game_num_in_season,
        {lagged(named.FORM_STD, 's')}, {lagged(named.FORM_L5, 'l5')}, {lagged(named.FORM_L3, 'l3')}, COUNT(*) OVER s AS games_played_std, CAST(SUM(win_flag) OVER l5 AS BIGINT) AS wins_l5
      FROM {{int_team_game}} WHERE season_type = 'regular' WINDOW {frames('team, season', l5=5, l3=3)}) f
LEFT JOIN (SELECT team AS t, season + 1 AS y, {', '.join(f'AVG({c}) AS {o}' for o, c in named.PRIOR.items())} FROM {{int_team_game}} WHERE season_type = 'regular' GROUP BY 1, 2) p ON f.team = p.t AND f.season = p.y
"""

_groups = []
for _g in named.INJURY_GROUPS:
    for _name, _cond in (("out", "OUT"), ("doubtful", "DOUBTFUL"), ("questionable", "QUESTIONABLE")):
        if _name == "out" or _g in ("QB", "WR"):
            _groups.append(f"COUNT(*) FILTER (grp = '{_g}' AND upper(report_status) = '{_cond}') AS {_g.lower()}_{_name}")
    _groups.append(f"COALESCE(CAST(SUM(injury_severity_score) FILTER (grp = '{_g}') AS BIGINT), 0) AS {_g.lower()}_burden")
SQL["int_injury_team_impact"] = f"""
SELECT team, season, week, CAST(SUM(injury_severity_score) AS BIGINT) AS total_injury_burden, {', '.join(_groups)}
FROM (SELECT *, {lookup('position', {k: v for k, v in POSITION_GROUPS.items() if v not in 'KP'}, 'OTHER')} AS grp FROM {{stg_injuries_weekly}} WHERE upper(report_status) != 'FULL') t GROUP BY 1, 2, 3
"""

SQL["int_player_game"] = f"""
SELECT p.player_id, p.full_name, p.position, p.position_group, p.team, p.opponent, p.season, p.week, p.season_type, g.game_id, g.game_date, g.home_team, g.away_team, {one('p.team = g.home_team')} AS home_flag,
  {plain(' '.join(named.PLAYER_GAME), 'p.')}, {', '.join(f'CASE WHEN {d} > 0 THEN p.{n} / {d} END AS {o}' for o, (n, d) in named.PLAYER_RATIOS.items())}, s.offense_snaps, s.offense_snap_pct
FROM {{stg_player_week}} p LEFT JOIN {{stg_games}} g ON p.season = g.season AND p.week = g.week AND (p.team = g.home_team OR p.team = g.away_team) AND g.season_type IN ('regular', 'postseason')
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY season, week, team, full_name ORDER BY pfr_player_id) AS rn FROM {{stg_snap_counts_weekly}}) s
  ON p.season = s.season AND p.week = s.week AND p.team = s.team AND p.full_name = s.full_name AND s.rn = 1
"""

SQL["int_player_form"] = f"""
SELECT player_id, full_name, position, position_group, team, season, week, ROW_NUMBER() OVER (PARTITION BY player_id, season ORDER BY week, game_id) AS game_num,
  {lagged({f'{o}_std': c for o, c in named.PLAYER_STD.items()}, 's')}, {lagged({f'{o}_l4': named.PLAYER_STD[o] for o in named.PLAYER_L4}, 'l4')},
  {lagged({f'{o}_l2': named.PLAYER_STD[o] for o in named.PLAYER_L2}, 'l2')}, COUNT(*) OVER s AS games_played_std
FROM {{int_player_game}} WHERE season_type = 'REG' WINDOW {frames('player_id, season', l4=4, l2=2)}
"""

SQL["int_qb_team_context"] = f"""
SELECT q.game_id, q.player_id, q.full_name, q.team, q.opponent, q.season, q.week, q.home_flag, q.game_date, {plain(' '.join(named.QB_COLUMNS), 'q.')},
  q.carries AS qb_carries, q.rushing_yards AS qb_rush_yards, q.rushing_tds AS qb_rush_tds, t.pass_rate, t.offensive_plays, t.pass_epa_per_dropback AS team_pass_epa, t.sacks_allowed AS oline_sacks_allowed,
  o.def_sacks AS opp_def_sacks, o.def_pass_epa_per_dropback AS opp_def_pass_epa, COALESCE(i.wr_burden, 0) + COALESCE(i.te_burden, 0) AS skill_position_injury_burden, i.wr_out, i.te_out
FROM (SELECT * FROM {{int_player_game}} WHERE position = 'QB' AND attempts >= 5) q LEFT JOIN {{int_team_game}} t ON q.game_id = t.game_id AND q.team = t.team
LEFT JOIN {{int_team_game}} o ON q.game_id = o.game_id AND q.opponent = o.team LEFT JOIN {{int_injury_team_impact}} i ON q.team = i.team AND q.season = i.season AND q.week = i.week
"""


def crossing(k: int) -> str:
    parts = [f"ol {a} {s} AND cl {b} {s}" for s in (k, -k) for a, b in (("<", ">="), (">", "<="))]
    return f"CASE WHEN market_type = 'spread' THEN {one(' OR '.join(parts))} END AS crossed_key_{k}_flag"


SQL["opened"] = """
SELECT game_id, season, week, home_team, away_team, market_type, selection, line AS ol, price_american AS opening_price, implied_prob_raw AS opening_implied_prob, market_timestamp_utc AS open_timestamp
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, season, week, market_type, selection, home_team, away_team ORDER BY market_timestamp_utc, source_name, sportsbook, event_id) AS rn
      FROM {stg_market_game_line} WHERE snapshot_type IN ('opening', 'intraday') AND game_id IS NOT NULL) t WHERE rn = 1
"""
SQL["int_market_open_close"] = f"""
SELECT game_id, season, week, home_team, away_team, market_type, selection, ol AS opening_line, opening_price, opening_implied_prob, open_timestamp, cl AS closing_line, closing_price_american, closing_implied_prob,
  close_timestamp, close_sportsbook, cl - ol AS move_open_to_close, abs(cl - ol) AS abs_move_open_to_close, {one('ol > 0 AND cl < 0 OR ol < 0 AND cl > 0')} AS favorite_flip_flag, {crossing(3)}, {crossing(7)}, {crossing(10)},
  CASE WHEN abs(ol) > 0.5 THEN abs(cl - ol) / abs(ol) ELSE abs(cl - ol) END AS line_volatility_score, close_consensus_dispersion, close_book_count, CAST(NULL AS DOUBLE) AS opening_implied_home_total,
  {one("market_type = 'spread' AND selection = 'home' AND ol < 0")} AS home_fav_opening, {one("market_type = 'spread' AND selection = 'home' AND ol > 0")} AS home_dog_opening,
  {one("market_type = 'spread' AND selection = 'away' AND ol < 0")} AS road_fav_opening
FROM {{opened}}
LEFT JOIN (SELECT game_id, market_type, selection, closing_line AS cl, closing_price_american, closing_implied_prob, close_timestamp, close_sportsbook FROM {{stg_market_close_game}}) USING (game_id, market_type, selection)
LEFT JOIN (SELECT game_id, market_type, selection, line_stddev AS close_consensus_dispersion, book_count AS close_book_count FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, market_type, selection ORDER BY market_timestamp DESC) AS rn FROM {{stg_market_consensus_game}} WHERE snapshot_type = 'closing') t WHERE rn = 1)
  USING (game_id, market_type, selection)
"""

SQL["int_market_time_buckets"] = """
SELECT game_id, market_type, selection, time_bucket, season, week, line AS bucket_line, price_american AS bucket_price, implied_prob_raw AS bucket_implied_prob, market_timestamp_utc AS bucket_timestamp, hours AS hours_before_kickoff
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, market_type, selection, time_bucket ORDER BY market_timestamp_utc DESC, source_name DESC, sportsbook DESC, event_id DESC) AS rn
      FROM (SELECT *, CASE WHEN hours > 120 THEN 'open' WHEN hours >= 72 THEN '72h' WHEN hours >= 24 THEN '24h' WHEN hours >= 6 THEN '6h' WHEN hours >= 1 THEN '1h' ELSE 'close' END AS time_bucket
            FROM (SELECT l.*, (epoch(k.kickoff_ts_approx) - epoch(l.market_timestamp_utc)) / 3600 AS hours FROM {stg_market_game_line} l JOIN {stg_weather_game_kickoff} k USING (game_id)) a WHERE hours >= 0) b) c WHERE rn = 1
"""

# The rating as the step-by-step recursion it is defined by (the relation uses running sums).
SQL["seq_games"] = "SELECT game_id, team, season, week, home_flag, win_flag, ROW_NUMBER() OVER (PARTITION BY team ORDER BY season, week, game_id) AS num FROM {int_team_game} WHERE season_type = 'regular'"
SQL["rated"] = """
SELECT game_id, team, season, week, home_flag, win_flag, num, 1500.0::DOUBLE AS pre, 1500.0::DOUBLE + COALESCE(20.0::DOUBLE * (win_flag - 1 / (1 + pow(10.0::DOUBLE, -65 / 400.0::DOUBLE))), 0) AS post FROM {seq_games} WHERE num = 1
UNION ALL
SELECT g.game_id, g.team, g.season, g.week, g.home_flag, g.win_flag, g.num, CASE WHEN g.season > r.season THEN r.post + 0.33::DOUBLE * (1500 - r.post) ELSE r.post END,
  CASE WHEN g.win_flag IS NULL THEN r.post ELSE CASE WHEN g.season > r.season THEN r.post + 0.33::DOUBLE * (1500 - r.post) ELSE r.post END
    + 20.0::DOUBLE * (g.win_flag - 1 / (1 + pow(10.0::DOUBLE, CASE g.home_flag WHEN 1 THEN -65 ELSE 65 END / 400.0::DOUBLE))) END
FROM {seq_games} g JOIN rated r ON g.team = r.team AND g.num = r.num + 1
"""
SQL["int_team_power_rating"] = """
SELECT r.game_id, r.team, r.season, r.week, r.home_flag, r.win_flag, ROUND(r.pre, 1) AS elo_rating_pregame, ROUND(r.post, 1) AS elo_rating_postgame, f.epa_pp_blended AS offensive_power, f.def_epa_pp_blended AS defensive_power,
  f.epa_pp_blended + abs(f.def_epa_pp_blended) AS total_environment_rating, f.pass_epa_std AS qb_pass_epa_context, f.pass_rate_std AS pace_proxy
FROM {rated} r JOIN {int_team_form} f ON r.team = f.team AND r.season = f.season AND r.week = f.week
"""


def piece(value: str, cap: int) -> str:
    return f"LEAST(GREATEST({value}, 0.0::DOUBLE), {cap}.0::DOUBLE)"


_flags = {
    "cold_flag": "temp_f < 32", "very_cold_flag": "temp_f < 20", "hot_flag": "temp_f > 85", "wind_10_flag": "wind_mph >= 10", "wind_15_flag": "wind_mph >= 15", "wind_20_flag": "wind_mph >= 20",
    "wind_25_flag": "wind_mph >= 25", "precip_flag": "precip_in > 1", "snow_flag": "snow_in > 0.5", "high_humidity_flag": "humidity_pct > 80", "cold_wind_interaction": "temp_f < 32 AND wind_mph >= 10",
}
SQL["int_weather_game"] = f"""
SELECT game_id, season, week, stadium_id, roof_closed_flag, open_air_weather_applicable, weather_source_type, forecast_run_ts, temp_f, apparent_temp_f, wind_mph, wind_gusts_mph, wind_dir_deg, precip_in, rain_in, snow_in,
  snow_depth_in, humidity_pct, dew_point_f, pressure_hpa, weather_condition, CASE WHEN shut THEN 72 ELSE temp_f END AS eff_temp_f, CASE WHEN shut THEN 0 ELSE wind_mph END AS eff_wind_mph,
  CASE WHEN shut THEN 0 ELSE precip_in END AS eff_precip_in, CASE WHEN shut THEN 0 ELSE snow_in END AS eff_snow_in, {', '.join(f'{one(f"NOT shut AND {c}")} AS {n}' for n, c in _flags.items())},
  CASE WHEN shut THEN 'dome' WHEN wind_mph >= 25 THEN 'severe_wind' WHEN wind_mph >= 20 THEN 'strong_wind' WHEN wind_mph >= 15 THEN 'moderate_wind' WHEN wind_mph >= 10 THEN 'mild_wind' ELSE 'calm' END AS wind_bucket,
  CASE WHEN shut THEN 'dome' WHEN temp_f < 20 THEN 'extreme_cold' WHEN temp_f < 32 THEN 'freezing' WHEN temp_f < 45 THEN 'cold' WHEN temp_f < 55 THEN 'cool' WHEN temp_f < 70 THEN 'mild' WHEN temp_f < 85 THEN 'warm' ELSE 'hot' END AS temp_bucket,
  CASE WHEN shut THEN 0 ELSE LEAST(100, {piece('(wind_mph - 5) * 2.5::DOUBLE', 40)} + {piece('32 - temp_f', 25)} + {piece('precip_in * 20', 25)} + {piece('snow_in * 20', 10)}) END AS adverse_weather_score,
  CASE WHEN shut THEN 100 ELSE GREATEST(0, 100 - LEAST(100, {piece('(wind_mph - 5) * 3.5::DOUBLE', 60)} + {piece('(32 - temp_f) * 0.8::DOUBLE', 20)} + {piece('precip_in * 15', 20)})) END AS passing_condition_score,
  CASE WHEN shut THEN 0 ELSE {one('wind_mph >= 20')} * 2 + {one('temp_f < 32')} + {one('precip_in > 1')} END AS total_suppression_score
FROM (SELECT *, roof_closed_flag = 1 AS shut FROM {{stg_weather_game_kickoff}}) t
"""

SQL["horizons"] = """
SELECT k.*, x.prediction_horizon, x.hours_before_event, k.kickoff_ts_approx - x.hours_before_event * INTERVAL '1' HOUR AS cutoff
FROM {kicked} k CROSS JOIN (VALUES ('early_week', 120), ('mid_week', 72), ('pre_kickoff', 1)) x(prediction_horizon, hours_before_event)
"""
SQL["weather_horizon"] = f"""
SELECT k.game_id, k.prediction_horizon, k.hours_before_event, k.season, k.week, k.stadium_id, {plain(WEATHER, 'w.')}, w.weather_type AS weather_source_type, w.forecast_run_ts,
  {one('k.shut')} AS roof_closed_flag, CASE WHEN k.shut THEN 0 ELSE 1 END AS open_air_weather_applicable
FROM {{horizons}} k LEFT JOIN (
  SELECT r.game_id, r.prediction_horizon, h.*, ROW_NUMBER() OVER (PARTITION BY r.game_id, r.prediction_horizon
    ORDER BY abs(epoch(h.weather_ts) - epoch(r.kickoff_ts_approx)), h.weather_ts, COALESCE(h.weather_code, -1) DESC) AS rn
  FROM (SELECT k.game_id, k.prediction_horizon, k.kickoff_ts_approx, k.stadium_id, MAX(h.forecast_run_ts) AS run FROM {{horizons}} k
        JOIN {{stg_weather_game_hourly}} h ON k.stadium_id = h.stadium_id AND h.weather_type = 'forecast' AND h.forecast_run_ts < k.cutoff GROUP BY 1, 2, 3, 4) r
  JOIN {{stg_weather_game_hourly}} h ON r.stadium_id = h.stadium_id AND h.weather_type = 'forecast' AND h.forecast_run_ts = r.run AND h.weather_ts IS NOT NULL) w
  ON k.game_id = w.game_id AND k.prediction_horizon = w.prediction_horizon AND w.rn = 1
"""
SQL["int_weather_horizon"] = (
    SQL["int_weather_game"]
    .replace("SELECT game_id, season", "SELECT game_id, prediction_horizon, hours_before_event, season", 1)
    .replace("{stg_weather_game_kickoff}", "{weather_horizon}")
)

SQL["int_team_travel_game"] = f"""
SELECT t.* EXCLUDE (away_team, home_team), z.home_timezone AS away_team_home_tz FROM (
  SELECT g.game_id, g.season, g.week, g.home_team, g.away_team, x.is_away_team, CASE x.is_away_team WHEN 1 THEN g.away_team ELSE g.home_team END AS team, g.home_team AS game_location_team, s.timezone AS game_venue_tz,
    CASE x.is_away_team WHEN 1 THEN c.travel_km ELSE 0 END AS travel_km, CASE x.is_away_team WHEN 1 THEN c.travel_miles ELSE 0 END AS travel_miles, CASE x.is_away_team WHEN 1 THEN c.timezone_shift_hours ELSE 0 END AS timezone_shift_hours,
    CASE x.is_away_team WHEN 1 THEN c.east_to_west_flag ELSE 0 END AS east_to_west_flag, CASE x.is_away_team WHEN 1 THEN c.west_to_east_flag ELSE 0 END AS west_to_east_flag,
    CASE x.is_away_team WHEN 1 THEN c.international_travel_flag ELSE 0 END AS international_travel_flag, CASE x.is_away_team WHEN 1 THEN c.international_travel_flag ELSE 0 END AS intl_travel_flag,
    CASE WHEN x.is_away_team = 0 THEN 'home' WHEN c.travel_km < 500 THEN 'short' WHEN c.travel_km < 1500 THEN 'medium' WHEN c.travel_km < 3000 THEN 'long' ELSE 'cross_country' END AS travel_distance_bucket,
    {one('x.is_away_team = 1 AND c.west_to_east_flag = 1 AND c.timezone_shift_hours >= 2')} AS west_east_early_flag
  FROM {{stg_games}} g CROSS JOIN (VALUES (1), (0)) x(is_away_team) LEFT JOIN {{stg_travel_context}} c ON g.season = c.season AND g.home_team = c.home_team AND g.away_team = c.away_team
  LEFT JOIN {{stg_stadium}} s ON g.home_team = s.team AND g.season BETWEEN s.season_start AND s.season_end) t
LEFT JOIN {{raw_team_timezone_reference}} z ON t.team = z.team AND t.season = z.season
"""

# --- marts -------------------------------------------------------------------------------------


def side(alias: str, prefix: str, names: str) -> str:
    """'source:output …' of one side's relation under its role prefix."""
    out = []
    for part in names.split():
        source, _, name = part.partition(":")
        out.append(f"{alias}.{source} AS {prefix}{name or source}")
    return ", ".join(out)


def on_week(rel: str, alias: str, team: str, base: str = "g") -> str:
    return f"LEFT JOIN {{{rel}}} {alias} ON {base}.{team} = {alias}.team AND {base}.season = {alias}.season AND {base}.week = {alias}.week"


def on_game(rel: str, alias: str, team: str | None = None) -> str:
    extra = f" AND g.{team} = {alias}.team" if team else ""
    return f"LEFT JOIN {{{rel}}} {alias} ON g.game_id = {alias}.game_id{extra}"


def beaten(value: str, line: str) -> str:
    return f"CASE WHEN {value} > {line} THEN 1 WHEN {value} <= {line} THEN 0 END"


_form = named.FORM_BASE + " turnovers_per_game_std:turnovers_pg_std games_played_std:games_played"
_hurt = "total_injury_burden:injury_burden " + named.INJURY_BASE
SQL["mart_game_modeling_base"] = f"""
SELECT g.* EXCLUDE (pfr_game_id, espn_game_id, nfl_detail_id), s.schedule_spread_line AS spread_line_nflverse, s.schedule_total_line AS total_line_nflverse, s.schedule_home_ml AS home_ml_nflverse,
  s.schedule_away_ml AS away_ml_nflverse, {side('h', 'home_', _form)}, {side('a', 'away_', _form)}, {side('hi', 'home_', _hurt)}, {side('ai', 'away_', _hurt)},
  {beaten('g.home_margin', '-s.schedule_spread_line')} AS home_covered_flag, {beaten('g.total_points', 's.schedule_total_line')} AS over_flag
FROM {{int_game_base}} g LEFT JOIN {{stg_games}} s ON g.game_id = s.game_id {on_week('int_team_form', 'h', 'home_team')} {on_week('int_team_form', 'a', 'away_team')}
{on_week('int_injury_team_impact', 'hi', 'home_team')} {on_week('int_injury_team_impact', 'ai', 'away_team')}
"""

SQL["mart_team_week_modeling"] = f"""
SELECT f.team, f.season, f.week, f.game_id, f.game_date, {plain(named.FORM_WEEK, 'f.')}, i.total_injury_burden, {plain(named.INJURY_BASE, 'i.')}
FROM {{int_team_form}} f {on_week('int_injury_team_impact', 'i', 'team', 'f')}
"""


def split(train_before: int, through: int) -> str:
    return f"CASE WHEN season < {train_before} THEN 'train' WHEN season <= {through} THEN 'validation' ELSE 'test' END AS cv_split"


SQL["mart_backtest_game_base"] = f"""
SELECT *, {split(2018, 2021)} FROM {{mart_game_modeling_base}} WHERE game_completed_flag = 1 AND season_type = 'regular' AND home_games_played >= 1 AND away_games_played >= 1
"""

SQL["mart_player_week_projection"] = f"""
SELECT p.player_id, p.full_name, p.position, p.position_group, p.team, p.season, p.week, {cast(' '.join(f'p.{c}:{c}' for c in named.PLAYER_FORM.split()), 'DOUBLE')}, w.opponent, w.home_flag, w.game_id,
  {side('t', 'team_', 'epa_pp_blended:epa_blended pass_epa_std rush_epa_std pass_rate_std pts_for_std')},
  {side('o', 'opp_', 'def_epa_pp_blended:def_epa_blended def_pass_epa_std def_rush_epa_std def_success_rate_allowed_std:def_success_rate def_sacks_std')}, {side('i', 'opp_', 'cb_burden dl_burden lb_burden')},
  r.report_status AS injury_status, r.sev AS injury_severity_score, {cast(' '.join(f'g.{s.split(":")[0]}:actual_{s.split(":")[1]}' for s in named.ACTUALS.split()), 'DOUBLE')},
  {one("upper(r.report_status) IN ('OUT', 'DOUBTFUL')")} AS injury_out_flag
FROM {{int_player_form}} p {on_week('stg_team_week', 'w', 'team', 'p')} {on_week('mart_team_week_modeling', 't', 'team', 'p')}
LEFT JOIN {{mart_team_week_modeling}} o ON w.opponent = o.team AND p.season = o.season AND p.week = o.week LEFT JOIN {{int_injury_team_impact}} i ON w.opponent = i.team AND p.season = i.season AND p.week = i.week
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY gsis_id, season, week ORDER BY date_modified DESC, sev DESC, report_status DESC NULLS LAST) AS rn FROM (SELECT *, {SEVERITY} AS sev FROM {{raw_injuries}}) n) r
  ON p.player_id = r.gsis_id AND p.season = r.season AND p.week = r.week AND r.rn = 1
LEFT JOIN {{int_player_game}} g ON p.player_id = g.player_id AND p.season = g.season AND p.week = g.week
"""


def tracking(cols: str) -> str:
    means = ", ".join(f"AVG({c}) OVER w AS {c}" for c in cols.split())
    return f"(SELECT player_id, season, week, {means} FROM {{stg_nextgen_player_week}} WHERE season_type = 'REG' WINDOW w AS (PARTITION BY player_id, season ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"


SQL["mart_qb_projection"] = f"""
SELECT q.* EXCLUDE (attempts, passing_air_yards, comp_pct, yards_per_attempt, offensive_plays), q.attempts AS actual_pass_attempts,
  {plain('attempts_per_game_std pass_yds_per_game_std pass_tds_per_game_std pass_epa_per_game_std rush_yds_per_game_std attempts_per_game_l4 pass_yds_per_game_l4', 'p.')}, CAST(p.games_played_std AS DOUBLE) AS games_played_std,
  n.avg_intended_air_yards AS ngs_intended_air_yards_std
FROM {{int_qb_team_context}} q LEFT JOIN {{int_player_form}} p ON q.player_id = p.player_id AND q.season = p.season AND q.week = p.week
LEFT JOIN {tracking('avg_intended_air_yards')} n ON q.player_id = n.player_id AND q.season = n.season AND q.week = n.week
"""

SQL["mart_receiver_projection"] = f"""
SELECT {plain(named.PROJECTION_ID + ' targets_per_game_std rec_per_game_std rec_yds_per_game_std rec_tds_per_game_std target_share_std air_yards_share_std wopr_std snap_pct_std targets_per_game_l4 target_share_l4 targets_per_game_l2 rec_epa_per_game_std team_epa_blended team_pass_rate_std team_pts_for_std opp_def_epa_blended opp_def_pass_epa_std opp_cb_burden opp_dl_burden injury_status injury_out_flag actual_targets actual_receptions actual_rec_yards actual_rec_tds actual_fpts_std actual_fpts_ppr', 'p.')},
  {plain(named.RECEIVER_TRACKING, 'n.')}
FROM {{mart_player_week_projection}} p LEFT JOIN {tracking(named.RECEIVER_TRACKING)} n ON p.player_id = n.player_id AND p.season = n.season AND p.week = n.week WHERE p.position_group IN ('WR', 'TE')
"""

SQL["mart_rusher_projection"] = f"""
SELECT {plain(named.PROJECTION_ID + ' carries_per_game_std rush_yds_per_game_std rush_tds_per_game_std rush_epa_per_game_std carries_per_game_l4 rush_yds_per_game_l4 carries_per_game_l2 snap_pct_std snap_pct_l4 targets_per_game_std rec_per_game_std rec_yds_per_game_std target_share_std team_pass_rate_std team_pts_for_std team_epa_blended opp_def_rush_epa_std opp_lb_burden opp_dl_burden injury_status injury_out_flag actual_carries actual_rush_yards actual_rush_tds actual_targets actual_rec_yards actual_fpts_std actual_fpts_ppr')},
  {cast('NULL:rush_efficiency NULL:stacked_box_pct NULL:ryoe NULL:ryoe_per_att NULL:avg_time_to_los', 'DOUBLE')}
FROM {{mart_player_week_projection}} WHERE position_group = 'RB'
"""

_played = "COALESCE(actual_targets, actual_carries, actual_pass_attempts) IS NOT NULL"
SQL["mart_backtest_player_base"] = f"SELECT *, {split(2015, 2019)} FROM {{mart_player_week_projection}} WHERE {_played}"

_wx = named.WEATHER_SHARED
_lines = "(SELECT * FROM {int_market_open_close} WHERE market_type = 'KIND' AND selection = 'SIDE')"


def line_of(kind: str, selection: str, alias: str) -> str:
    return "LEFT JOIN " + _lines.replace("KIND", kind).replace("SIDE", selection) + f" {alias} ON g.game_id = {alias}.game_id"


def bucket_of(kind: str, selection: str, label: str, alias: str) -> str:
    where = f"market_type = '{kind}' AND selection = '{selection}' AND time_bucket = '{label}'"
    return f"LEFT JOIN (SELECT * FROM {{int_market_time_buckets}} WHERE {where}) {alias} ON g.game_id = {alias}.game_id"


_star = " ".join(
    f"{on_week('mart_team_week_modeling', s, team)} {on_game('int_team_power_rating', s + 'r', team)} {on_game('int_team_schedule_spot', s + 'q', team)} {on_week('int_injury_team_impact', s + 'i', team)}"
    for s, team in (("h", "home_team"), ("a", "away_team"))
)
_trip = "LEFT JOIN (SELECT * FROM {int_team_travel_game} WHERE is_away_team = 1) t ON g.game_id = t.game_id AND g.away_team = t.team"
_venue = "LEFT JOIN {stg_stadium} st ON g.home_team = st.team AND g.season BETWEEN st.season_start AND st.season_end"

_spread_form = "epa_pp_blended:epa_blended epa_pp_l5:epa_l5 epa_pp_l3:epa_l3 def_epa_pp_blended:def_epa_blended games_played_std:games_played"
_spread_rate = "elo_rating_pregame:elo offensive_power defensive_power"
_spread_spot = "rest_days short_week_flag:short_week bye_week_prior_flag:bye_prior long_rest_flag:long_rest"
SQL["mart_spread_modeling"] = f"""
SELECT g.game_id, g.season, g.week, g.season_type, g.game_date, g.home_team, g.away_team, g.primetime_flag, g.div_game, g.conf_game, g.surface, g.roof, g.location, g.home_score, g.away_score, g.home_margin, g.home_win_flag, g.game_completed_flag,
  {', '.join(f"{side(s, f'{p}_', _spread_form)}, {side(s + 'r', f'{p}_', _spread_rate)}, {side(s + 'q', f'{p}_', _spread_spot)}, {s}i.qb_out AS {p}_qb_out, {s}i.ol_burden AS {p}_ol_burden, {s}i.wr_burden + COALESCE({s}i.te_burden, 0) AS {p}_skill_burden" for s, p in (('h', 'home'), ('a', 'away')))},
  aq.third_road_in_four_flag AS away_third_road_four, {side('t', 'away_', 'travel_km timezone_shift_hours:tz_shift west_east_early_flag:west_east_early intl_travel_flag:intl_travel')}, {plain(_wx, 'w.')},
  o.opening_line AS opening_spread, o.opening_implied_prob AS opening_home_win_prob, o.home_fav_opening, o.home_dog_opening, o.road_fav_opening, o.closing_line AS closing_spread, o.crossed_key_3_flag AS spread_crossed_3,
  o.crossed_key_7_flag AS spread_crossed_7, o.line_volatility_score AS spread_line_volatility, o.move_open_to_close AS spread_move_otc, b.bucket_line AS spread_24h, b.bucket_implied_prob AS win_prob_24h,
  h.epa_pp_blended - a.epa_pp_blended AS home_epa_advantage, h.def_epa_pp_blended - a.def_epa_pp_blended AS home_def_epa_advantage,
  (h.epa_pp_blended + a.def_epa_pp_blended) - (a.epa_pp_blended + h.def_epa_pp_blended) AS composite_strength_diff, h.pass_epa_std - a.pass_epa_std AS home_pass_epa_delta, h.rush_epa_std - a.rush_epa_std AS home_rush_epa_delta,
  h.success_rate_std - a.success_rate_std AS home_success_rate_delta, hr.elo_rating_pregame - ar.elo_rating_pregame AS elo_diff, hq.rest_days - COALESCE(aq.rest_days, 7) AS rest_advantage_home,
  hi.total_injury_burden - ai.total_injury_burden AS injury_burden_diff_home, {beaten('g.home_margin', '-o.closing_line')} AS home_covered_close,
  {one('g.home_win_flag = 1 AND o.home_fav_opening = 1 OR g.home_win_flag = 0 AND o.home_dog_opening = 1')} AS bet_side_won, 1 AS football_only_available, {one('o.opening_line IS NOT NULL')} AS market_available
FROM {{int_game_base}} g {_star} {_trip} {on_game('int_weather_game', 'w')} {line_of('spread', 'home', 'o')} {bucket_of('spread', 'home', '24h', 'b')}
"""

_sums = {
    "combined_off_epa": "epa_pp_blended", "combined_def_epa": "def_epa_pp_blended", "combined_pts_for_pg": "pts_for_std", "combined_pts_against_pg": "pts_against_std", "combined_pass_rate": "pass_rate_std",
    "combined_explosive_rate": "explosive_pass_rate_std", "combined_rz_td_rate": "rz_td_rate_std", "combined_turnovers_pg": "turnovers_per_game_std",
}
SQL["mart_total_modeling"] = f"""
SELECT g.game_id, g.season, g.week, g.season_type, g.game_date, g.home_team, g.away_team, g.surface, g.roof, g.location, g.div_game, g.home_score, g.away_score, g.total_points, g.game_completed_flag,
  {', '.join(f'h.{m} + a.{m} AS {o}' for o, m in _sums.items())}, hr.total_environment_rating AS home_total_env, ar.total_environment_rating AS away_total_env,
  hr.total_environment_rating + ar.total_environment_rating AS combined_total_env, h.pass_rate_std AS home_pass_rate, a.pass_rate_std AS away_pass_rate, hq.rest_days AS home_rest, aq.rest_days AS away_rest,
  hi.total_injury_burden AS home_injury_burden, ai.total_injury_burden AS away_injury_burden, {plain(_wx + ' total_suppression_score snow_flag precip_flag wind_20_flag', 'w.')}, st.elevation_m, st.altitude_flag,
  st.international_game_flag, o.opening_line AS opening_total, o.opening_implied_prob AS opening_over_prob, o.closing_line AS closing_total, o.move_open_to_close AS total_move_otc, o.line_volatility_score AS total_line_volatility,
  b.bucket_line AS total_24h, o.opening_line / 2 - s.opening_line / 2 AS implied_home_team_total_open, o.opening_line / 2 + s.opening_line / 2 AS implied_away_team_total_open,
  {beaten('g.total_points', 'o.closing_line')} AS over_close_flag, {beaten('g.total_points', 'o.opening_line')} AS over_open_flag, {one('o.opening_line IS NOT NULL')} AS market_available
FROM {{int_game_base}} g {_star} {on_game('int_weather_game', 'w')} {_venue} {line_of('total', 'over', 'o')} {bucket_of('total', 'over', '24h', 'b')} {line_of('spread', 'home', 's')}
"""

SQL["both_sides"] = """
SELECT game_id, market_type, CASE WHEN selection IN ('home', 'away') THEN 1 ELSE 2 END AS pair, SUM(opening_implied_prob) AS po, COUNT(opening_implied_prob) AS no, SUM(closing_implied_prob) AS pc, COUNT(closing_implied_prob) AS nc
FROM {int_market_open_close} GROUP BY 1, 2, 3
"""


def novig(moment: str, letter: str) -> str:
    fallback = f"CASE WHEN o.market_type IN ('spread', 'total') THEN 0.5238::DOUBLE ELSE o.{moment}_implied_prob END"
    return f"CASE WHEN f.n{letter} = 2 THEN o.{moment}_implied_prob / f.p{letter} ELSE {fallback} END AS {moment}_novig_prob"


_sp, _to = "o.market_type = 'spread' AND o.selection = 'home'", "o.market_type = 'total' AND o.selection = 'over'"
SQL["mart_market_research_game"] = f"""
SELECT o.* EXCLUDE (opening_price, closing_price_american, close_sportsbook, opening_implied_home_total, home_fav_opening, home_dog_opening, road_fav_opening),
  {', '.join(f"(SELECT MAX(b.bucket_line) FROM {{int_market_time_buckets}} b WHERE b.game_id = o.game_id AND b.market_type = o.market_type AND b.selection = o.selection AND b.time_bucket = '{h}') AS line_{h}" for h in ('72h', '24h', '6h', '1h'))},
  c.book_count AS open_book_count, g.home_score, g.away_score, g.home_margin, g.total_points, g.home_win_flag, {plain('eff_wind_mph eff_temp_f wind_bucket temp_bucket adverse_weather_score roof_closed_flag', 'w.')},
  {novig('closing', 'c')}, {novig('opening', 'o')}, CASE WHEN {_sp} THEN {beaten('g.home_margin', '-o.opening_line')} END AS covered_open_flag, CASE WHEN {_sp} THEN {beaten('g.home_margin', '-o.closing_line')} END AS covered_close_flag,
  CASE WHEN {_to} THEN {beaten('g.total_points', 'o.opening_line')} END AS over_open_flag, CASE WHEN {_to} THEN {beaten('g.total_points', 'o.closing_line')} END AS over_close_flag,
  CASE WHEN {_sp} THEN o.opening_line - o.closing_line END AS open_vs_close_clv
FROM {{int_market_open_close}} o LEFT JOIN {{int_game_base}} g ON o.game_id = g.game_id LEFT JOIN {{int_weather_game}} w ON o.game_id = w.game_id
LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY game_id, market_type, selection ORDER BY market_timestamp) AS rn FROM {{stg_market_consensus_game}} WHERE snapshot_type = 'opening') c
  ON o.game_id = c.game_id AND o.market_type = c.market_type AND o.selection = c.selection AND c.rn = 1
LEFT JOIN {{both_sides}} f ON o.game_id = f.game_id AND o.market_type = f.market_type AND f.pair = CASE WHEN o.selection IN ('home', 'away') THEN 1 ELSE 2 END
"""

_game_form = (
    "epa_pp_blended:epa_blended epa_pp_std:epa_std epa_pp_l5:epa_l5 epa_pp_l3:epa_l3 pass_epa_std:pass_epa rush_epa_std:rush_epa def_epa_pp_blended:def_epa def_pass_epa_std:def_pass_epa success_rate_std:success_rate "
    "pass_rate_std:pass_rate explosive_pass_rate_std:explosive_pass rz_td_rate_std:rz_td_rate turnovers_per_game_std:to_pg def_to_forced_std:def_to_forced pts_for_std:pts_for_pg pts_against_std:pts_against_pg "
    "games_played_std:games_played wins_l5"
)
_game_spot = "third_road_in_four_flag:third_road_four consecutive_road_games_prior:consec_road long_rest_flag:long_rest"
SQL["mart_game_modeling"] = f"""
SELECT g.* EXCLUDE (pfr_game_id, espn_game_id, nfl_detail_id), st.roof_type AS stadium_roof_type, st.surface_type AS stadium_surface_type, st.elevation_m, st.altitude_flag, st.international_game_flag, st.venue_category,
  {', '.join(f"{side(s, f'{p}_', _game_form)}, {side(s + 'r', f'{p}_', 'elo_rating_pregame:elo offensive_power:off_power defensive_power:def_power')}, {side(s + 'q', f'{p}_', _game_spot)}, {side(s + 'i', f'{p}_', 'total_injury_burden:injury_burden qb_out ol_burden wr_burden')}" for s, p in (('h', 'home'), ('a', 'away')))},
  t.travel_km, t.travel_miles, t.travel_distance_bucket, {side('t', 'away_', 'timezone_shift_hours:tz_shift east_to_west_flag:east_to_west west_to_east_flag:west_to_east west_east_early_flag:west_east_early intl_travel_flag:intl_travel')},
  {plain(_wx + ' weather_condition total_suppression_score cold_flag wind_20_flag wind_15_flag precip_flag snow_flag forecast_run_ts', 'w.')}, o.opening_line AS opening_spread, o.opening_implied_prob AS opening_home_win_prob,
  o.closing_line AS closing_spread, o.move_open_to_close AS spread_move, o.line_volatility_score AS spread_volatility, o.close_consensus_dispersion AS spread_close_dispersion,
  {plain('crossed_key_3_flag crossed_key_7_flag crossed_key_10_flag home_fav_opening home_dog_opening road_fav_opening', 'o.')}, u.opening_line AS opening_total, u.closing_line AS closing_total, u.move_open_to_close AS total_move,
  m.opening_line AS opening_home_ml, m.closing_line AS closing_home_ml, h.epa_pp_blended - a.epa_pp_blended AS epa_diff, (h.epa_pp_blended + a.def_epa_pp_blended) - (a.epa_pp_blended + h.def_epa_pp_blended) AS composite_diff,
  hr.elo_rating_pregame - ar.elo_rating_pregame AS elo_diff, hr.total_environment_rating + ar.total_environment_rating AS total_env_combined, u.opening_line / 2 - o.opening_line / 2 AS opening_home_team_total,
  u.opening_line / 2 + o.opening_line / 2 AS opening_away_team_total, {one('o.opening_line IS NOT NULL')} AS odds_available, {one('w.eff_temp_f IS NOT NULL')} AS weather_available, {one('hr.elo_rating_pregame IS NOT NULL')} AS elo_available,
  {beaten('g.home_margin', '-o.closing_line')} AS home_covered_close, {beaten('g.total_points', 'u.closing_line')} AS over_close_flag,
  {cast('NULL:model_home_win_prob NULL:model_spread_prediction NULL:model_total_prediction NULL:model_edge_spread NULL:model_edge_total', 'DOUBLE')}
FROM {{int_game_base}} g {_star} {_trip} {on_game('int_weather_game', 'w')} {_venue} {line_of('spread', 'home', 'o')} {line_of('total', 'over', 'u')} {line_of('moneyline', 'home', 'm')}
"""

SQL["mart_game_modeling_no_market"] = f"SELECT {plain(named.NO_MARKET)} FROM {{mart_game_modeling}}"

SQL["mart_backtest_game"] = f"""
SELECT {plain(named.BACKTEST, 'g.')}, x.prediction_horizon, x.hours_before_kickoff, s.bucket_line AS spread_at_horizon, {one('s.bucket_line IS NOT NULL')} AS market_available_at_horizon, s.bucket_implied_prob AS win_prob_at_horizon,
  t.bucket_line AS total_at_horizon, t.bucket_line / 2 - s.bucket_line / 2 AS implied_home_total_at_horizon, {split(2015, 2019).replace('season', 'g.season')}
FROM {{mart_game_modeling}} g CROSS JOIN (VALUES ('early_week', 120, 'open'), ('mid_week', 72, '72h'), ('pre_kickoff', 1, '1h')) x(prediction_horizon, hours_before_kickoff, bucket)
LEFT JOIN {{int_market_time_buckets}} s ON g.game_id = s.game_id AND s.market_type = 'spread' AND s.selection = 'home' AND s.time_bucket = x.bucket
LEFT JOIN {{int_market_time_buckets}} t ON g.game_id = t.game_id AND t.market_type = 'total' AND t.selection = 'over' AND t.time_bucket = x.bucket
WHERE g.game_completed_flag = 1 AND g.season_type = 'regular' AND g.home_games_played >= 1 AND g.away_games_played >= 1
"""

_forecast = "eff_temp_f eff_wind_mph eff_precip_in wind_bucket temp_bucket adverse_weather_score passing_condition_score cold_wind_interaction weather_source_type forecast_run_ts"
SQL["mart_backtest_game_forecast"] = f"""
SELECT b.* EXCLUDE ({', '.join(_forecast.split())}), {plain(_forecast, 'w.')} FROM {{mart_backtest_game}} b
LEFT JOIN {{int_weather_horizon}} w ON b.game_id = w.game_id AND b.prediction_horizon = w.prediction_horizon
"""

SQL["mart_backtest_player"] = f"""
SELECT x.prediction_horizon, {plain(named.PLAYER_BACKTEST, 'p.')}, {plain('eff_temp_f eff_wind_mph eff_precip_in wind_bucket adverse_weather_score passing_condition_score total_suppression_score roof_closed_flag weather_source_type', 'w.')},
  CASE p.home_flag WHEN 1 THEN m.opening_home_team_total ELSE m.opening_away_team_total END AS team_implied_total_opening, {split(2015, 2019).replace('season', 'p.season')}
FROM {{mart_player_week_projection}} p CROSS JOIN (VALUES ('early_week'), ('mid_week'), ('pre_kickoff')) x(prediction_horizon) LEFT JOIN {{int_weather_game}} w ON p.game_id = w.game_id
LEFT JOIN {{mart_game_modeling}} m ON p.game_id = m.game_id WHERE {_played}
"""

# --- composition -------------------------------------------------------------------------------

RAW = {**derived.SQL, **derived.ORACLE_ONLY}
RECURSIVE = {"rated"}


def compose(name: str, final: str) -> str:
    """`final` over everything `name` needs, as one statement that works out each relation once.

    Relations are materialised: under an outer LIMIT the engine otherwise never ends on some of the marts.
    """
    done: dict[str, str] = {}

    def visit(n: str) -> None:
        if n in done or n in derived.TABLES:
            return
        text = SQL.get(n) or RAW[n]
        for need in derived.needs(text):
            visit(need)
        done[n] = text.format(**{x: x for x in derived.needs(text)}).strip()

    visit(name)
    body = ",\n".join(f"{n} AS MATERIALIZED ({text})" for n, text in done.items())
    return f"WITH RECURSIVE {body}\n{final}"


def compose_all(names: list[str], final: str) -> str:
    """`final` over several relations."""
    SQL["__all"] = "SELECT 1 AS x WHERE FALSE " + " ".join(f"AND EXISTS (SELECT 1 FROM {{{n}}})" for n in names)
    try:
        return compose("__all", final)
    finally:
        del SQL["__all"]


# --- dimensions and facts ----------------------------------------------------------------------

SQL["dim_season"] = """
SELECT season, CASE WHEN bool_or(season_type = 'postseason') THEN 'postseason' ELSE 'regular' END AS season_type, season AS league_year, MIN(game_date) AS season_start_date, MAX(game_date) AS season_end_date,
  MIN(week) FILTER (season_type = 'postseason') AS playoffs_start_week, MAX(week) FILTER (game_type = 'SB') AS super_bowl_week FROM {stg_games} GROUP BY season
"""
SQL["dim_week"] = "SELECT season, week, MAX(season_type) AS season_type, MIN(game_date) AS week_start_date, MAX(game_date) AS week_end_date FROM {stg_games} GROUP BY 1, 2"
SQL["dim_team"] = f"""
SELECT team_abbr, team_name AS full_name, {cast('NULL:short_name', 'VARCHAR')}, team_conf AS conference, team_division AS division, {cast('NULL:team_color NULL:team_color2 NULL:team_logo_url', 'VARCHAR')},
  team_abbr AS current_abbr, 1 AS active_flag FROM {{stg_teams}}
"""
SQL["dim_player"] = f"SELECT * EXCLUDE (short_name), {cast('NULL:pfr_id NULL:espn_id NULL:sleeper_id', 'VARCHAR')} FROM {{stg_players}}"
SQL["fact_injury_status"] = """
SELECT season, week, player_id, team, report_date, position, report_status, report_primary_injury AS injury_type, injury_severity_score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY season, week, player_id, report_date ORDER BY injury_severity_score DESC, report_status DESC NULLS LAST, report_primary_injury DESC) AS rn FROM {stg_injuries_weekly}) t
WHERE rn = 1 AND report_date IS NOT NULL
"""
SQL["fact_depth_chart"] = "SELECT DISTINCT season, week, club_code AS team, gsis_id AS player_id, position, CAST(depth_team AS INTEGER) AS depth_team, formation FROM {raw_depth_charts}"
SQL["fact_market_game_snapshot"] = """
SELECT source_name, sportsbook, game_id, market_timestamp_utc AS market_timestamp, market_type, selection, season, week, line, price_american, price_decimal, implied_prob_raw, snapshot_type
FROM {stg_market_game_line} WHERE game_id IS NOT NULL
"""
_weather_cols = "source_name stadium_id latitude longitude weather_type weather_ts forecast_run_ts game_date season temp_f apparent_temp_f precip_in rain_in snow_in wind_mph wind_gusts_mph wind_dir_deg humidity_pct dew_point_f pressure_hpa weather_code weather_condition"
SQL["fact_weather_game_hourly"] = f"SELECT {plain(_weather_cols)} FROM {{stg_weather_game_hourly}}"
SQL["fact_weather_game_forecast"] = """
SELECT source_name, stadium_id, latitude, longitude, forecast_run_ts, weather_ts AS forecast_target_ts, game_date, season, temp_f, apparent_temp_f, precip_in, snow_in, wind_mph, wind_gusts_mph, wind_dir_deg, humidity_pct, weather_code, weather_condition
FROM {stg_weather_game_hourly} WHERE weather_type = 'forecast'
"""


def projections() -> None:
    """Tables that are typed projections of one relation."""
    from leaksafe.plans.dimensions import PROJECTED

    names = {"string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP"}
    prepared = {
        "fact_drive": "(SELECT *, COALESCE(interceptions, 0) + COALESCE(fumbles_lost, 0) AS turnovers FROM {stg_drives})",
        "fact_player_game": "(SELECT * FROM {int_player_game} WHERE game_id IS NOT NULL)",
    }
    for table_name, (source, spec) in PROJECTED.items():
        cols = ", ".join(f'CAST("{col}" AS {names[t]}) AS "{out}"' for out, (col, t) in spec.items() if out != "ingestion_ts")
        SQL[table_name] = f"SELECT {cols} FROM {prepared.get(table_name, '{' + source + '}')} x"


projections()
