"""Output columns and what they come from, as the SQL of the relations states them.

Written a second time on purpose: the relations have maps of their own, so that a wrong pair in either shows as a difference.
"""

# The names of the required schema.
FORM_L3 = {
    "epa_pp_l3": "epa_per_play",
    "pass_epa_l3": "pass_epa_per_dropback",
    "def_epa_pp_l3": "def_epa_per_play",
    "pts_for_l3": "points_for",
    "pts_against_l3": "points_against",
}
FORM_L5 = {
    "epa_pp_l5": "epa_per_play",
    "pass_epa_l5": "pass_epa_per_dropback",
    "rush_epa_l5": "rush_epa_per_carry",
    "def_epa_pp_l5": "def_epa_per_play",
    "success_rate_l5": "success_rate",
    "def_success_rate_l5": "def_success_rate_allowed",
    "turnovers_l5": "turnovers",
    "pts_for_l5": "points_for",
    "pts_against_l5": "points_against",
}
FORM_STD = {
    "epa_pp_std": "epa_per_play",
    "pass_epa_std": "pass_epa_per_dropback",
    "rush_epa_std": "rush_epa_per_carry",
    "def_epa_pp_std": "def_epa_per_play",
    "def_pass_epa_std": "def_pass_epa_per_dropback",
    "def_rush_epa_std": "def_rush_epa_per_carry",
    "success_rate_std": "success_rate",
    "pass_success_rate_std": "pass_success_rate",
    "rush_success_rate_std": "rush_success_rate",
    "def_success_rate_allowed_std": "def_success_rate_allowed",
    "explosive_pass_rate_std": "explosive_pass_rate",
    "explosive_rush_rate_std": "explosive_rush_rate",
    "pass_rate_std": "pass_rate",
    "turnovers_per_game_std": "turnovers",
    "def_to_forced_std": "def_turnovers_forced",
    "sacks_allowed_std": "sacks_allowed",
    "def_sacks_std": "def_sacks",
    "rz_td_rate_std": "red_zone_td_rate",
    "pts_for_std": "points_for",
    "pts_against_std": "points_against",
}
INJURY_GROUPS = """
    QB OL WR TE RB DL LB CB S
""".split()
PLAYER_GAME = """
    completions attempts passing_yards passing_tds interceptions sacks passing_air_yards passing_yac passing_epa
    dakota carries rushing_yards rushing_tds rushing_epa targets receptions receiving_yards receiving_tds
    receiving_air_yards receiving_yac receiving_epa target_share air_yards_share wopr racr fantasy_points_std
    fantasy_points_ppr
""".split()
PLAYER_L2 = """
    targets_per_game rec_yds_per_game carries_per_game
""".split()
PLAYER_L4 = """
    targets_per_game rec_per_game rec_yds_per_game target_share snap_pct carries_per_game rush_yds_per_game
    attempts_per_game pass_yds_per_game
""".split()
PLAYER_RATIOS = {
    "comp_pct": ("completions", "attempts"),
    "yards_per_attempt": ("passing_yards", "attempts"),
    "yards_per_carry": ("rushing_yards", "carries"),
    "catch_rate": ("receptions", "targets"),
    "yards_per_target": ("receiving_yards", "targets"),
}
PLAYER_STD = {
    "targets_per_game": "targets",
    "rec_per_game": "receptions",
    "rec_yds_per_game": "receiving_yards",
    "rec_tds_per_game": "receiving_tds",
    "target_share": "target_share",
    "air_yards_share": "air_yards_share",
    "wopr": "wopr",
    "snap_pct": "offense_snap_pct",
    "carries_per_game": "carries",
    "rush_yds_per_game": "rushing_yards",
    "rush_tds_per_game": "rushing_tds",
    "attempts_per_game": "attempts",
    "pass_yds_per_game": "passing_yards",
    "pass_tds_per_game": "passing_tds",
    "rec_epa_per_game": "receiving_epa",
    "rush_epa_per_game": "rushing_epa",
    "pass_epa_per_game": "passing_epa",
}
PRIOR = {
    "prior_epa_pp": "epa_per_play",
    "prior_def_epa_pp": "def_epa_per_play",
    "prior_success_rate": "success_rate",
    "prior_pass_rate": "pass_rate",
}
QB_COLUMNS = """
    completions attempts passing_yards passing_tds interceptions sacks passing_air_yards passing_epa dakota comp_pct
    yards_per_attempt
""".split()
ACTUALS = """
    targets:targets receptions:receptions receiving_yards:rec_yards receiving_tds:rec_tds carries:carries
    rushing_yards:rush_yards rushing_tds:rush_tds attempts:pass_attempts passing_yards:pass_yards passing_tds:pass_tds
    fantasy_points_std:fpts_std fantasy_points_ppr:fpts_ppr
"""
BACKTEST = """
    game_id season week season_type game_date home_team away_team game_completed_flag home_epa_blended home_epa_l5
    home_epa_l3 away_epa_blended away_epa_l5 away_epa_l3 epa_diff composite_diff home_elo away_elo elo_diff
    home_off_power away_off_power home_def_power away_def_power home_pass_epa away_pass_epa home_def_epa away_def_epa
    home_success_rate away_success_rate home_pass_rate away_pass_rate home_rz_td_rate away_rz_td_rate
    home_games_played away_games_played home_rest_days away_rest_days rest_days_advantage_home home_short_week
    away_short_week home_bye_prior away_bye_prior home_long_rest away_long_rest home_third_road_four
    away_third_road_four travel_km away_tz_shift away_west_east_early away_intl_travel home_qb_out away_qb_out
    home_injury_burden away_injury_burden home_wr_burden away_wr_burden venue_category elevation_m altitude_flag
    international_game_flag roof_closed_flag div_game conf_game primetime_flag eff_temp_f eff_wind_mph eff_precip_in
    wind_bucket temp_bucket adverse_weather_score passing_condition_score total_suppression_score
    cold_wind_interaction snow_flag precip_flag weather_source_type forecast_run_ts home_score away_score total_points
    home_margin home_win_flag home_covered_close over_close_flag
"""
FORM_BASE = """
    epa_pp_blended def_epa_pp_blended epa_pp_std pass_epa_std rush_epa_std def_epa_pp_std def_pass_epa_std
    def_rush_epa_std success_rate_std def_success_rate_allowed_std explosive_pass_rate_std pass_rate_std
    def_to_forced_std rz_td_rate_std pts_for_std pts_against_std def_sacks_std sacks_allowed_std epa_pp_l5 pass_epa_l5
    def_epa_pp_l5 pts_for_l5 pts_against_l5 epa_pp_l3 prior_epa_pp prior_def_epa_pp
"""
FORM_WEEK = """
    epa_pp_blended epa_pp_std pass_epa_std rush_epa_std success_rate_std explosive_pass_rate_std pass_rate_std
    turnovers_per_game_std rz_td_rate_std pts_for_std pts_against_std sacks_allowed_std def_epa_pp_blended
    def_epa_pp_std def_pass_epa_std def_rush_epa_std def_success_rate_allowed_std def_to_forced_std def_sacks_std
    games_played_std epa_pp_l5 epa_pp_l3 prior_epa_pp prior_def_epa_pp wins_l5
"""
INJURY_BASE = """
    qb_out ol_burden wr_burden te_burden rb_out dl_burden cb_burden
"""
NO_MARKET = """
    game_id season week season_type game_date home_team away_team game_completed_flag surface roof location stadium
    div_game conf_game primetime_flag weekday venue_category elevation_m altitude_flag international_game_flag
    home_rest_days away_rest_days rest_days_advantage_home home_short_week away_short_week home_bye_prior
    away_bye_prior home_long_rest away_long_rest home_third_road_four away_third_road_four travel_km travel_miles
    away_tz_shift away_west_east_early away_intl_travel home_epa_blended home_epa_l5 home_pass_epa home_rush_epa
    home_def_epa home_success_rate home_pass_rate home_rz_td_rate home_games_played home_wins_l5 away_epa_blended
    away_epa_l5 away_pass_epa away_rush_epa away_def_epa away_success_rate away_pass_rate away_rz_td_rate
    away_games_played away_wins_l5 epa_diff composite_diff home_elo away_elo elo_diff home_off_power away_off_power
    home_def_power away_def_power total_env_combined home_injury_burden away_injury_burden home_qb_out away_qb_out
    home_wr_burden away_wr_burden eff_temp_f eff_wind_mph eff_precip_in wind_bucket temp_bucket adverse_weather_score
    passing_condition_score total_suppression_score roof_closed_flag cold_wind_interaction weather_source_type
    forecast_run_ts weather_available home_score away_score total_points home_margin home_win_flag
"""
PLAYER_BACKTEST = """
    player_id full_name position position_group team opponent season week game_id home_flag targets_per_game_std
    rec_per_game_std rec_yds_per_game_std target_share_std air_yards_share_std wopr_std snap_pct_std
    carries_per_game_std rush_yds_per_game_std rush_tds_per_game_std attempts_per_game_std pass_yds_per_game_std
    pass_tds_per_game_std games_played_std targets_per_game_l4 target_share_l4 carries_per_game_l4 targets_per_game_l2
    carries_per_game_l2 team_epa_blended team_pass_rate_std team_pts_for_std opp_def_epa_blended opp_def_pass_epa_std
    opp_def_rush_epa_std opp_cb_burden opp_dl_burden injury_status injury_out_flag actual_targets actual_receptions
    actual_rec_yards actual_rec_tds actual_carries actual_rush_yards actual_rush_tds actual_pass_attempts
    actual_pass_yards actual_pass_tds actual_fpts_std actual_fpts_ppr
"""
PLAYER_FORM = """
    targets_per_game_std rec_per_game_std rec_yds_per_game_std rec_tds_per_game_std target_share_std
    air_yards_share_std wopr_std snap_pct_std carries_per_game_std rush_yds_per_game_std rush_tds_per_game_std
    attempts_per_game_std pass_yds_per_game_std pass_tds_per_game_std rec_epa_per_game_std rush_epa_per_game_std
    pass_epa_per_game_std games_played_std targets_per_game_l4 rec_yds_per_game_l4 target_share_l4 snap_pct_l4
    carries_per_game_l4 rush_yds_per_game_l4 attempts_per_game_l4 pass_yds_per_game_l4 targets_per_game_l2
    rec_yds_per_game_l2 carries_per_game_l2
"""
PROJECTION_ID = """
    game_id player_id full_name position team opponent season week home_flag
"""
RECEIVER_TRACKING = """
    avg_separation avg_cushion catch_percentage avg_yac avg_yac_above_expectation
"""
WEATHER_SHARED = """
    eff_wind_mph eff_temp_f eff_precip_in wind_bucket temp_bucket adverse_weather_score passing_condition_score
    roof_closed_flag open_air_weather_applicable cold_wind_interaction weather_source_type
"""
