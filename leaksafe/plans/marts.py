"""Mart relations: wide, leakage-aware training tables assembled by star joins on their own grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import available, flag, pick_by_role
from leaksafe.functions.odds import side_totals
from leaksafe.operators import asof, horizons, rolling
from leaksafe.operators.joins import validity_join
from leaksafe.operators.consensus import fair_two_way
from leaksafe.operators.marts import Join, assemble, min_history, placeholder, temporal_split
from leaksafe.operators.quality import with_zone
from leaksafe.plans.catalog import Catalog
from leaksafe.plans.staging import severity

MARTS = Catalog()

# Seasons that bound the splits (train before, validation through).
BASE_SPLIT = (2018, 2021)
SPLIT = (2015, 2019)
# Fixed value: implied probability of a standard −110 price, used where only one side is quoted.
STANDARD_PROB = 0.5238
HORIZON_LABELS = ("72h", "24h", "6h", "1h")


def keep(names: str, prefix: str = "") -> dict[str, str]:
    return {f"{prefix}{n}": n for n in names.split()}


def pairs(text: str, prefix: str = "") -> dict[str, str]:
    """'source:output' pairs as {prefix + output: source}."""
    return {prefix + p.split(":")[1]: p.split(":")[0] for p in text.split()}


def by_week(side: DataFrame, team: str, cols: Mapping[str, str]) -> Join:
    return Join(side, {team: "team", "season": "season", "week": "week"}, cols)


def by_game(side: DataFrame, cols: Mapping[str, str], team: str | None = None) -> Join:
    return Join(side, {"game_id": "game_id", **({team: "team"} if team else {})}, cols)


def beat(value: str | Column, line: str | Column) -> Column:
    """1 if the value exceeds the line, 0 if not, NULL if either is missing."""
    value, line = (F.col(c) if isinstance(c, str) else c for c in (value, line))
    return (value > line).cast("int")


def venue_at_season(games: DataFrame, stadiums: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Venue columns of the home team's stadium in the game's season, one row per game."""
    sides = stadiums.select(
        F.col("team").alias("__team"), "season_start", "season_end", "stadium_id", *[F.col(c).alias(o) for o, c in cols.items()]
    )
    rows = games.select("game_id", "season", F.col("home_team").alias("__team"))
    return validity_join(rows, sides, "__team", "season").select("game_id", *cols)


def market(open_close: DataFrame, kind: str, selection: str) -> DataFrame:
    return open_close.filter((F.col("market_type") == kind) & (F.col("selection") == selection))


def bucket(buckets: DataFrame, kind: str, selection: str, label: str) -> DataFrame:
    return market(buckets, kind, selection).filter(F.col("time_bucket") == label)


FORM_BASE = (
    "epa_pp_blended def_epa_pp_blended epa_pp_std pass_epa_std rush_epa_std def_epa_pp_std def_pass_epa_std def_rush_epa_std "
    "success_rate_std def_success_rate_allowed_std explosive_pass_rate_std pass_rate_std def_to_forced_std rz_td_rate_std "
    "pts_for_std pts_against_std def_sacks_std sacks_allowed_std epa_pp_l5 pass_epa_l5 def_epa_pp_l5 pts_for_l5 "
    "pts_against_l5 epa_pp_l3 prior_epa_pp prior_def_epa_pp"
)
INJURY_BASE = "qb_out ol_burden wr_burden te_burden rb_out dl_burden cb_burden"
SIDES = (("home", "home_team"), ("away", "away_team"))


@MARTS.relation(
    "int_game_base", "stg_games", "int_team_form", "int_injury_team_impact", key=("game_id",),
    materialise=True, partition=("season",), stay=True,
)
def mart_game_modeling_base(games, schedule, form, injuries) -> DataFrame:
    lines = {f"{line}_nflverse": f"schedule_{line}" for line in ("spread_line", "total_line", "home_ml", "away_ml")}
    base = games.drop("pfr_game_id", "espn_game_id", "nfl_detail_id")
    joins_ = [by_game(schedule, lines)]
    for side, team in SIDES:
        cols = {
            **keep(FORM_BASE, f"{side}_"),
            **pairs("turnovers_per_game_std:turnovers_pg_std games_played_std:games_played", f"{side}_"),
        }
        joins_.append(by_week(form, team, cols))
        hurt = {**pairs("total_injury_burden:injury_burden", f"{side}_"), **keep(INJURY_BASE, f"{side}_")}
        joins_.append(by_week(injuries, team, hurt))
    out = assemble(base, joins_, at=["game_id"])
    return out.withColumns(
        {
            "home_covered_flag": beat("home_margin", -F.col("spread_line_nflverse")),
            "over_flag": beat("total_points", "total_line_nflverse"),
        }
    )


FORM_WEEK = (
    "epa_pp_blended epa_pp_std pass_epa_std rush_epa_std success_rate_std explosive_pass_rate_std pass_rate_std "
    "turnovers_per_game_std rz_td_rate_std pts_for_std pts_against_std sacks_allowed_std def_epa_pp_blended def_epa_pp_std "
    "def_pass_epa_std def_rush_epa_std def_success_rate_allowed_std def_to_forced_std def_sacks_std games_played_std epa_pp_l5 "
    "epa_pp_l3 prior_epa_pp prior_def_epa_pp wins_l5"
)


@MARTS.relation(
    "int_team_form", "int_injury_team_impact", key=("season", "week", "team"), materialise=True, partition=("season",), stay=True,
    deal=("team", "season"),
)
def mart_team_week_modeling(form, injuries) -> DataFrame:
    base = form.select("team", "season", "week", "game_id", "game_date", *FORM_WEEK.split())
    return assemble(base, [by_week(injuries, "team", keep(f"total_injury_burden {INJURY_BASE}"))])


@MARTS.relation("mart_game_modeling_base", key=("game_id",))
def mart_backtest_game_base(games) -> DataFrame:
    played = games.filter((F.col("game_completed_flag") == 1) & (F.col("season_type") == "regular"))
    return min_history(played, ["home_games_played", "away_games_played"], 1).withColumn(
        "cv_split", temporal_split("season", *BASE_SPLIT)
    )


# --- players -----------------------------------------------------------------------------------

PLAYER_FORM = (
    "targets_per_game_std rec_per_game_std rec_yds_per_game_std rec_tds_per_game_std target_share_std air_yards_share_std "
    "wopr_std snap_pct_std carries_per_game_std rush_yds_per_game_std rush_tds_per_game_std attempts_per_game_std "
    "pass_yds_per_game_std pass_tds_per_game_std rec_epa_per_game_std rush_epa_per_game_std pass_epa_per_game_std "
    "games_played_std targets_per_game_l4 rec_yds_per_game_l4 target_share_l4 snap_pct_l4 carries_per_game_l4 "
    "rush_yds_per_game_l4 attempts_per_game_l4 pass_yds_per_game_l4 targets_per_game_l2 rec_yds_per_game_l2 carries_per_game_l2"
)
ACTUALS = (
    "targets:targets receptions:receptions receiving_yards:rec_yards receiving_tds:rec_tds carries:carries "
    "rushing_yards:rush_yards rushing_tds:rush_tds attempts:pass_attempts passing_yards:pass_yards passing_tds:pass_tds "
    "fantasy_points_std:fpts_std fantasy_points_ppr:fpts_ppr"
)


@MARTS.relation(
    "int_player_form", "stg_team_week", "mart_team_week_modeling", "int_injury_team_impact", "raw_injuries", "int_player_game",
    key=("season", "week", "player_id"),
    materialise=True, partition=("season",), stay=True,
)
def mart_player_week_projection(form, sides, teams, injuries, reports, games) -> DataFrame:
    player = ["player_id", "season", "week"]
    reports = reports.filter(F.col("gsis_id").isNotNull()).select(
        F.col("gsis_id").cast("string").alias("player_id"), F.col("season").cast("int").alias("season"),
        F.col("week").cast("int").alias("week"), "report_status", "date_modified", severity("report_status").alias("severity"),
    )
    # The latest report per player and week; on one day the more severe one.
    latest = asof.last_per_key(reports, player, "date_modified", ["severity", "report_status"], ["report_status", "severity"])
    base = form.select(
        "player_id", "full_name", "position", "position_group", "team", "season", "week",
        *[F.col(c).cast("double").alias(c) for c in PLAYER_FORM.split()],
    )
    own = pairs(
        "epa_pp_blended:epa_blended pass_epa_std:pass_epa_std rush_epa_std:rush_epa_std pass_rate_std:pass_rate_std "
        "pts_for_std:pts_for_std",
        "team_",
    )
    other = pairs(
        "def_epa_pp_blended:def_epa_blended def_pass_epa_std:def_pass_epa_std def_rush_epa_std:def_rush_epa_std "
        "def_success_rate_allowed_std:def_success_rate def_sacks_std:def_sacks_std",
        "opp_",
    )
    actual = games.select(*player, *[F.col(c).cast("double").alias(f"actual_{o}") for o, c in pairs(ACTUALS).items()])
    on_player = {c: c for c in player}
    week = by_week(sides, "team", keep("opponent home_flag game_id"))
    of_player = [
        Join(latest, on_player, {"injury_status": "report_status", "injury_severity_score": "severity"}),
        Join(actual, on_player, {c: c for c in actual.columns[3:]}),
    ]
    of_team = [
        by_week(teams, "team", own),
        by_week(teams, "opponent", other),
        by_week(injuries, "opponent", keep("cb_burden dl_burden lb_burden", "opp_")),
    ]
    # What is joined by player comes first: the form's windows left the rows dealt by player and season.
    out = assemble(base, [*of_player, week, *of_team])
    out = out.select(*base.columns, *[c for j in (week, *of_team, *of_player) for c in j.cols])
    # Statuses arrive in any case; the level already ignores it.
    return out.withColumn("injury_out_flag", flag(F.upper("injury_status").isin("OUT", "DOUBTFUL")))


def tracking_form(tracking: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Season-to-date means of tracking measures before each week, one row per player and week.

    Several kinds of rows of one week are averaged first; the reference sees one kind only.
    """
    regular = tracking.filter(F.col("season_type") == "REG")
    weekly = regular.groupBy("player_id", "season", "week").agg(*[F.avg(c).alias(c) for c in cols])
    out = rolling.lagged(weekly, ["player_id", "season"], ["week"], cols, {"std": None}, count=None)
    return out.drop(*cols).withColumnsRenamed({f"{c}_std": c for c in cols})


PLAYER_KEY = {c: c for c in ("player_id", "season", "week")}


@MARTS.relation("int_qb_team_context", "int_player_form", "stg_nextgen_player_week", key=("game_id", "player_id"))
def mart_qb_projection(context, form, tracking) -> DataFrame:
    base = context.withColumnsRenamed({"attempts": "actual_pass_attempts"}).select(
        "game_id", "player_id", "full_name", "team", "opponent", "season", "week", "home_flag", "game_date", "pass_rate",
        "team_pass_epa", "oline_sacks_allowed", "opp_def_sacks", "opp_def_pass_epa", "skill_position_injury_burden", "wr_out",
        "te_out", "completions", "actual_pass_attempts", "passing_yards", "passing_tds", "interceptions", "sacks",
        "passing_epa", "dakota", "qb_carries", "qb_rush_yards", "qb_rush_tds",
    )
    wanted = (
        "attempts_per_game_std pass_yds_per_game_std pass_tds_per_game_std pass_epa_per_game_std rush_yds_per_game_std "
        "attempts_per_game_l4 pass_yds_per_game_l4"
    )
    form = form.withColumn("games_played_std", F.col("games_played_std").cast("double"))
    depth = tracking_form(tracking, ["avg_intended_air_yards"])
    return assemble(
        base,
        [
            Join(form, PLAYER_KEY, keep(wanted + " games_played_std")),
            Join(depth, PLAYER_KEY, {"ngs_intended_air_yards_std": "avg_intended_air_yards"}),
        ],
    )


PROJECTION_ID = "game_id player_id full_name position team opponent season week home_flag"
RECEIVER_TRACKING = "avg_separation avg_cushion catch_percentage avg_yac avg_yac_above_expectation"


@MARTS.relation("mart_player_week_projection", "stg_nextgen_player_week", key=("season", "week", "player_id"))
def mart_receiver_projection(players, tracking) -> DataFrame:
    cols = (
        f"{PROJECTION_ID} targets_per_game_std rec_per_game_std rec_yds_per_game_std rec_tds_per_game_std target_share_std "
        "air_yards_share_std wopr_std snap_pct_std targets_per_game_l4 target_share_l4 targets_per_game_l2 "
        "rec_epa_per_game_std team_epa_blended team_pass_rate_std team_pts_for_std opp_def_epa_blended opp_def_pass_epa_std "
        "opp_cb_burden opp_dl_burden injury_status injury_out_flag actual_targets actual_receptions actual_rec_yards "
        "actual_rec_tds actual_fpts_std actual_fpts_ppr"
    )
    base = players.filter(F.col("position_group").isin("WR", "TE")).select(*cols.split())
    form = tracking_form(tracking, RECEIVER_TRACKING.split())
    return assemble(base, [Join(form, PLAYER_KEY, keep(RECEIVER_TRACKING))])


@MARTS.relation("mart_player_week_projection", key=("season", "week", "player_id"))
def mart_rusher_projection(players) -> DataFrame:
    cols = (
        f"{PROJECTION_ID} carries_per_game_std rush_yds_per_game_std rush_tds_per_game_std rush_epa_per_game_std "
        "carries_per_game_l4 rush_yds_per_game_l4 carries_per_game_l2 snap_pct_std snap_pct_l4 targets_per_game_std "
        "rec_per_game_std rec_yds_per_game_std target_share_std team_pass_rate_std team_pts_for_std team_epa_blended "
        "opp_def_rush_epa_std opp_lb_burden opp_dl_burden injury_status injury_out_flag actual_carries actual_rush_yards "
        "actual_rush_tds actual_targets actual_rec_yards actual_fpts_std actual_fpts_ppr"
    )
    base = players.filter(F.col("position_group") == "RB").select(*cols.split())
    absent = ("rush_efficiency", "stacked_box_pct", "ryoe", "ryoe_per_att", "avg_time_to_los")
    return placeholder(base, dict.fromkeys(absent, "double"))


def _played(players: DataFrame) -> DataFrame:
    return players.filter(
        F.coalesce("actual_targets", "actual_carries", "actual_pass_attempts").isNotNull()
    )


@MARTS.relation("mart_player_week_projection", key=("season", "week", "player_id"))
def mart_backtest_player_base(players) -> DataFrame:
    return _played(players).withColumn("cv_split", temporal_split("season", *SPLIT))


# --- games with market, weather, travel --------------------------------------------------------

WEATHER_SHARED = (
    "eff_wind_mph eff_temp_f eff_precip_in wind_bucket temp_bucket adverse_weather_score passing_condition_score "
    "roof_closed_flag open_air_weather_applicable cold_wind_interaction weather_source_type"
)


@MARTS.relation(
    "int_game_base", "mart_team_week_modeling", "int_team_power_rating", "int_team_schedule_spot", "int_team_travel_game",
    "int_injury_team_impact", "int_weather_game", "int_market_open_close", "int_market_time_buckets", key=("game_id",),
    materialise=True, partition=("season",), stay=True,
)
def mart_spread_modeling(games, teams, ratings, spots, travel, injuries, weather, lines, buckets) -> DataFrame:
    base = games.select(
        "game_id", "season", "week", "season_type", "game_date", "home_team", "away_team", "primetime_flag", "div_game",
        "conf_game", "surface", "roof", "location", "home_score", "away_score", "home_margin", "home_win_flag",
        "game_completed_flag",
    )
    joins_ = []
    for side, team in SIDES:
        form = pairs(
            "epa_pp_blended:epa_blended epa_pp_l5:epa_l5 epa_pp_l3:epa_l3 def_epa_pp_blended:def_epa_blended "
            "games_played_std:games_played pass_epa_std:__pass rush_epa_std:__rush success_rate_std:__success",
            f"{side}_",
        )
        joins_ += [
            by_week(teams, team, form),
            by_game(ratings, pairs("elo_rating_pregame:elo offensive_power:offensive_power defensive_power:defensive_power", f"{side}_"), team),
            by_game(spots, pairs("rest_days:rest_days short_week_flag:short_week bye_week_prior_flag:bye_prior long_rest_flag:long_rest third_road_in_four_flag:third_road_four", f"{side}_"), team),
            by_week(injuries, team, pairs("total_injury_burden:__burden qb_out:qb_out ol_burden:ol_burden wr_burden:__wr te_burden:__te", f"{side}_")),
        ]
    trips = travel.filter("is_away_team = 1")
    joins_ += [
        by_game(trips, pairs("travel_km:travel_km timezone_shift_hours:tz_shift west_east_early_flag:west_east_early intl_travel_flag:intl_travel", "away_"), "away_team"),
        by_game(weather, keep(WEATHER_SHARED)),
        by_game(
            market(lines, "spread", "home"),
            {
                **pairs("opening_line:opening_spread opening_implied_prob:opening_home_win_prob"),
                **keep("home_fav_opening home_dog_opening road_fav_opening"),
                **pairs("closing_line:closing_spread crossed_key_3_flag:spread_crossed_3 crossed_key_7_flag:spread_crossed_7 line_volatility_score:spread_line_volatility move_open_to_close:spread_move_otc"),
            },
        ),
        by_game(bucket(buckets, "spread", "home", "24h"), pairs("bucket_line:spread_24h bucket_implied_prob:win_prob_24h")),
    ]
    out = assemble(base, joins_, at=["game_id"])
    c = F.col
    zero = F.lit(0)
    out = out.withColumns(
        {
            "home_epa_advantage": c("home_epa_blended") - c("away_epa_blended"),
            "home_def_epa_advantage": c("home_def_epa_blended") - c("away_def_epa_blended"),
            "composite_strength_diff": (c("home_epa_blended") + c("away_def_epa_blended")) - (c("away_epa_blended") + c("home_def_epa_blended")),
            "home_pass_epa_delta": c("home___pass") - c("away___pass"),
            "home_rush_epa_delta": c("home___rush") - c("away___rush"),
            "home_success_rate_delta": c("home___success") - c("away___success"),
            "elo_diff": c("home_elo") - c("away_elo"),
            "rest_advantage_home": c("home_rest_days") - F.coalesce("away_rest_days", F.lit(7)),
            "injury_burden_diff_home": c("home___burden") - c("away___burden"),
            **{f"{s}_skill_burden": c(f"{s}___wr") + F.coalesce(f"{s}___te", zero) for s, _ in SIDES},
            "home_covered_close": beat("home_margin", -c("closing_spread")),
            "bet_side_won": flag(
                ((c("home_win_flag") == 1) & (c("home_fav_opening") == 1))
                | ((c("home_win_flag") == 0) & (c("home_dog_opening") == 1))
            ),
            "football_only_available": F.lit(1),
            "market_available": available("opening_spread"),
        }
    )
    out = out.drop(*[x for x in out.columns if "___" in x], "home_third_road_four")
    late = ["closing_spread", "spread_crossed_3", "spread_crossed_7", "spread_line_volatility", "spread_move_otc"]
    return with_zone(out, dict.fromkeys(late, 3))


@MARTS.relation(
    "int_game_base", "mart_team_week_modeling", "int_team_power_rating", "int_team_schedule_spot", "int_injury_team_impact",
    "int_weather_game", "stg_stadium", "int_market_open_close", "int_market_time_buckets", key=("game_id",),
    materialise=True, partition=("season",), stay=True,
)
def mart_total_modeling(games, teams, ratings, spots, injuries, weather, stadiums, lines, buckets) -> DataFrame:
    base = games.select(
        "game_id", "season", "week", "season_type", "game_date", "home_team", "away_team", "surface", "roof", "location",
        "div_game", "home_score", "away_score", "total_points", "game_completed_flag",
    )
    summed = {
        "combined_off_epa": "epa_pp_blended", "combined_def_epa": "def_epa_pp_blended", "combined_pts_for_pg": "pts_for_std",
        "combined_pts_against_pg": "pts_against_std", "combined_pass_rate": "pass_rate_std",
        "combined_explosive_rate": "explosive_pass_rate_std", "combined_rz_td_rate": "rz_td_rate_std",
        "combined_turnovers_pg": "turnovers_per_game_std",
    }
    joins_ = []
    for side, team in SIDES:
        joins_ += [
            by_week(teams, team, {f"{side}__{m}": m for m in summed.values()}),
            by_game(ratings, {f"{side}_total_env": "total_environment_rating"}, team),
            by_game(spots, {f"{side}_rest": "rest_days"}, team),
            by_week(injuries, team, {f"{side}_injury_burden": "total_injury_burden"}),
        ]
    venue = keep("elevation_m altitude_flag international_game_flag")
    joins_ += [
        by_game(weather, keep(WEATHER_SHARED + " total_suppression_score snow_flag precip_flag wind_20_flag")),
        by_game(venue_at_season(base, stadiums, venue), {v: v for v in venue}),
        by_game(market(lines, "total", "over"), pairs("opening_line:opening_total opening_implied_prob:opening_over_prob closing_line:closing_total move_open_to_close:total_move_otc line_volatility_score:total_line_volatility")),
        by_game(bucket(buckets, "total", "over", "24h"), pairs("bucket_line:total_24h")),
        by_game(market(lines, "spread", "home"), pairs("opening_line:__spread")),
    ]
    out = assemble(base, joins_, at=["game_id"])
    totals = side_totals("opening_total", "__spread")
    out = out.withColumns(
        {
            **{name: F.col(f"home__{m}") + F.col(f"away__{m}") for name, m in summed.items()},
            "combined_total_env": F.col("home_total_env") + F.col("away_total_env"),
            "home_pass_rate": F.col("home__pass_rate_std"),
            "away_pass_rate": F.col("away__pass_rate_std"),
            "implied_home_team_total_open": totals.getField("home"),
            "implied_away_team_total_open": totals.getField("away"),
            "over_close_flag": beat("total_points", "closing_total"),
            "over_open_flag": beat("total_points", "opening_total"),
            "market_available": available("opening_total"),
        }
    )
    out = out.drop("__spread", *[f"{s}__{m}" for s, _ in SIDES for m in summed.values()])
    late = ["closing_total", "total_move_otc", "total_line_volatility", "over_close_flag", "over_open_flag"]
    return with_zone(out, dict.fromkeys(late, 3))


@MARTS.relation(
    "int_market_open_close", "int_game_base", "int_weather_game", "stg_market_consensus_game", "int_market_time_buckets",
    "stg_market_close_game", "stg_market_game_line", key=("game_id", "market_type", "selection"),
    materialise=True, partition=("season",), stay=True,
)
def mart_market_research_game(lines, games, weather, consensus, buckets, closes, snapshots) -> DataFrame:
    """Line timelines with outcomes, for research after the game. Closing columns are not predictive."""
    keys = ["game_id", "market_type", "selection"]
    on = {k: k for k in keys}
    timeline = horizons.pivot(buckets, keys, "bucket_line", HORIZON_LABELS)
    opened = asof.first_per_key(
        consensus.filter("snapshot_type = 'opening'"), keys, "market_timestamp", ["season", "week"], ["book_count"]
    )
    base = lines.drop("opening_price", "closing_price_american", "close_sportsbook", "opening_implied_home_total", "home_fav_opening", "home_dog_opening", "road_fav_opening")
    # With both selections of a market quoted, the vig is removed; otherwise the standard price stands in.
    fair = _fair(lines, "closing_implied_prob", "closing"), _fair(lines, "opening_implied_prob", "opening")
    out = assemble(
        base,
        [
            Join(timeline, on, {f"line_{h}": f"line_{h}" for h in HORIZON_LABELS}),
            Join(opened, on, {"open_book_count": "book_count"}),
            by_game(games, keep("home_score away_score home_margin total_points home_win_flag")),
            by_game(weather, keep("eff_wind_mph eff_temp_f wind_bucket temp_bucket adverse_weather_score roof_closed_flag")),
            Join(fair[0], on, {"__closing_fair": "fair"}),
            Join(fair[1], on, {"__opening_fair": "fair"}),
        ],
    )
    two_way = F.col("market_type").isin("spread", "total")
    spread = (F.col("market_type") == "spread") & (F.col("selection") == "home")
    total = (F.col("market_type") == "total") & (F.col("selection") == "over")
    added = {}
    for moment in ("closing", "opening"):
        raw = F.col(f"{moment}_implied_prob")
        fallback = F.when(two_way, F.lit(STANDARD_PROB)).otherwise(raw)
        added[f"{moment}_novig_prob"] = F.coalesce(F.col(f"__{moment}_fair"), fallback)
    for name, line in (("open", "opening_line"), ("close", "closing_line")):
        added[f"covered_{name}_flag"] = F.when(spread, beat("home_margin", -F.col(line)))
        added[f"over_{name}_flag"] = F.when(total, beat("total_points", line))
    added["open_vs_close_clv"] = F.when(spread, F.col("opening_line") - F.col("closing_line"))
    return out.withColumns(added).drop("__closing_fair", "__opening_fair")


def _fair(lines: DataFrame, prob: str, name: str) -> DataFrame:
    """Fair probability per selection of markets quoted on both sides."""
    opposite = {"home": "away", "away": "home", "over": "under", "under": "over"}
    parts = []
    for a, b in (("home", "away"), ("over", "under")):
        sides = lines.filter(F.col("selection").isin(a, b))
        fair = fair_two_way(sides, ["game_id", "market_type"], "selection", prob, (a, b))
        for s in (a, b):
            parts.append(fair.select("game_id", "market_type", F.lit(s).alias("selection"), F.col(f"fair_{s}").alias("fair")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter(F.col("fair").isNotNull())


@MARTS.relation(
    "int_game_base", "mart_team_week_modeling", "int_team_power_rating", "int_team_schedule_spot", "int_team_travel_game",
    "int_injury_team_impact", "int_weather_game", "stg_stadium", "int_market_open_close", key=("game_id",),
    materialise=True, partition=("season",), stay=True, deal=("game_id",),
)
def mart_game_modeling(games, teams, ratings, spots, travel, injuries, weather, stadiums, lines) -> DataFrame:
    base = games.drop("pfr_game_id", "espn_game_id", "nfl_detail_id")
    joins_ = []
    for side, team in SIDES:
        form = pairs(
            "epa_pp_blended:epa_blended epa_pp_std:epa_std epa_pp_l5:epa_l5 epa_pp_l3:epa_l3 pass_epa_std:pass_epa "
            "rush_epa_std:rush_epa def_epa_pp_blended:def_epa def_pass_epa_std:def_pass_epa success_rate_std:success_rate "
            "pass_rate_std:pass_rate explosive_pass_rate_std:explosive_pass rz_td_rate_std:rz_td_rate "
            "turnovers_per_game_std:to_pg def_to_forced_std:def_to_forced pts_for_std:pts_for_pg "
            "pts_against_std:pts_against_pg games_played_std:games_played wins_l5:wins_l5",
            f"{side}_",
        )
        joins_ += [
            by_week(teams, team, form),
            by_game(ratings, pairs("elo_rating_pregame:elo offensive_power:off_power defensive_power:def_power total_environment_rating:__env", f"{side}_"), team),
            by_game(spots, pairs("third_road_in_four_flag:third_road_four consecutive_road_games_prior:consec_road long_rest_flag:long_rest", f"{side}_"), team),
            by_week(injuries, team, pairs("total_injury_burden:injury_burden qb_out:qb_out ol_burden:ol_burden wr_burden:wr_burden", f"{side}_")),
        ]
    venue = {
        **pairs("roof_type:stadium_roof_type surface_type:stadium_surface_type"),
        **keep("elevation_m altitude_flag international_game_flag venue_category"),
    }
    trips = travel.filter("is_away_team = 1")
    joins_ += [
        by_game(venue_at_season(base, stadiums, venue), {v: v for v in venue}),
        by_game(trips, {**keep("travel_km travel_miles travel_distance_bucket"), **pairs("timezone_shift_hours:tz_shift east_to_west_flag:east_to_west west_to_east_flag:west_to_east west_east_early_flag:west_east_early intl_travel_flag:intl_travel", "away_")}, "away_team"),
        by_game(weather, keep(WEATHER_SHARED + " weather_condition total_suppression_score cold_flag wind_20_flag wind_15_flag precip_flag snow_flag forecast_run_ts")),
        by_game(
            market(lines, "spread", "home"),
            {
                **pairs("opening_line:opening_spread opening_implied_prob:opening_home_win_prob closing_line:closing_spread move_open_to_close:spread_move line_volatility_score:spread_volatility close_consensus_dispersion:spread_close_dispersion"),
                **keep("crossed_key_3_flag crossed_key_7_flag crossed_key_10_flag home_fav_opening home_dog_opening road_fav_opening"),
            },
        ),
        by_game(market(lines, "total", "over"), pairs("opening_line:opening_total closing_line:closing_total move_open_to_close:total_move")),
        by_game(market(lines, "moneyline", "home"), pairs("opening_line:opening_home_ml closing_line:closing_home_ml")),
    ]
    out = assemble(base, joins_, at=["game_id"])
    c = F.col
    totals = side_totals("opening_total", "opening_spread")
    out = out.withColumns(
        {
            "epa_diff": c("home_epa_blended") - c("away_epa_blended"),
            "composite_diff": (c("home_epa_blended") + c("away_def_epa")) - (c("away_epa_blended") + c("home_def_epa")),
            "elo_diff": c("home_elo") - c("away_elo"),
            "total_env_combined": c("home___env") + c("away___env"),
            "opening_home_team_total": totals.getField("home"),
            "opening_away_team_total": totals.getField("away"),
            "odds_available": available("opening_spread"),
            "weather_available": available("eff_temp_f"),
            "elo_available": available("home_elo"),
            "home_covered_close": beat("home_margin", -c("closing_spread")),
            "over_close_flag": beat("total_points", "closing_total"),
        }
    ).drop("home___env", "away___env")
    later = ("model_home_win_prob", "model_spread_prediction", "model_total_prediction", "model_edge_spread", "model_edge_total")
    out = placeholder(out, dict.fromkeys(later, "double"))
    late = (
        "closing_spread closing_total closing_home_ml spread_move total_move crossed_key_3_flag crossed_key_7_flag "
        "crossed_key_10_flag spread_volatility spread_close_dispersion home_covered_close over_close_flag"
    )
    return with_zone(out, dict.fromkeys(late.split(), 3))


NO_MARKET = (
    "game_id season week season_type game_date home_team away_team game_completed_flag surface roof location stadium div_game "
    "conf_game primetime_flag weekday venue_category elevation_m altitude_flag international_game_flag home_rest_days "
    "away_rest_days rest_days_advantage_home home_short_week away_short_week home_bye_prior away_bye_prior home_long_rest "
    "away_long_rest home_third_road_four away_third_road_four travel_km travel_miles away_tz_shift away_west_east_early "
    "away_intl_travel home_epa_blended home_epa_l5 home_pass_epa home_rush_epa home_def_epa home_success_rate home_pass_rate "
    "home_rz_td_rate home_games_played home_wins_l5 away_epa_blended away_epa_l5 away_pass_epa away_rush_epa away_def_epa "
    "away_success_rate away_pass_rate away_rz_td_rate away_games_played away_wins_l5 epa_diff composite_diff home_elo away_elo "
    "elo_diff home_off_power away_off_power home_def_power away_def_power total_env_combined home_injury_burden "
    "away_injury_burden home_qb_out away_qb_out home_wr_burden away_wr_burden eff_temp_f eff_wind_mph eff_precip_in "
    "wind_bucket temp_bucket adverse_weather_score passing_condition_score total_suppression_score roof_closed_flag "
    "cold_wind_interaction weather_source_type forecast_run_ts weather_available home_score away_score total_points "
    "home_margin home_win_flag"
)


@MARTS.relation("mart_game_modeling", key=("game_id",))
def mart_game_modeling_no_market(games) -> DataFrame:
    return games.select(*NO_MARKET.split())


BACKTEST = (
    "game_id season week season_type game_date home_team away_team game_completed_flag home_epa_blended home_epa_l5 home_epa_l3 "
    "away_epa_blended away_epa_l5 away_epa_l3 epa_diff composite_diff home_elo away_elo elo_diff home_off_power away_off_power "
    "home_def_power away_def_power home_pass_epa away_pass_epa home_def_epa away_def_epa home_success_rate away_success_rate "
    "home_pass_rate away_pass_rate home_rz_td_rate away_rz_td_rate home_games_played away_games_played home_rest_days "
    "away_rest_days rest_days_advantage_home home_short_week away_short_week home_bye_prior away_bye_prior home_long_rest "
    "away_long_rest home_third_road_four away_third_road_four travel_km away_tz_shift away_west_east_early away_intl_travel "
    "home_qb_out away_qb_out home_injury_burden away_injury_burden home_wr_burden away_wr_burden venue_category elevation_m "
    "altitude_flag international_game_flag roof_closed_flag div_game conf_game primetime_flag eff_temp_f eff_wind_mph "
    "eff_precip_in wind_bucket temp_bucket adverse_weather_score passing_condition_score total_suppression_score "
    "cold_wind_interaction snow_flag precip_flag weather_source_type forecast_run_ts home_score away_score total_points "
    "home_margin home_win_flag home_covered_close over_close_flag"
)


@MARTS.relation(
    "mart_game_modeling", "int_market_time_buckets", key=("game_id", "prediction_horizon"),
    materialise=True, partition=("season",), stay=True, deal=("game_id",),
)
def mart_backtest_game(games, buckets) -> DataFrame:
    """One row per completed regular game and horizon; market columns are those known at the horizon."""
    played = games.filter((F.col("game_completed_flag") == 1) & (F.col("season_type") == "regular"))
    played = min_history(played, ["home_games_played", "away_games_played"], 1).select(*BACKTEST.split())
    rows = horizons.expand(played).withColumnRenamed("hours_before_event", "hours_before_kickoff")
    spread, total = market(buckets, "spread", "home"), market(buckets, "total", "over")
    rows = horizons.attach(rows, spread, ["game_id"], value="bucket_line", out="spread_at_horizon")
    rows = horizons.attach(rows, spread, ["game_id"], value="bucket_implied_prob", out="win_prob_at_horizon")
    rows = horizons.attach(rows, total, ["game_id"], value="bucket_line", out="total_at_horizon")
    home = side_totals("total_at_horizon", "spread_at_horizon").getField("home")
    return (
        rows.withColumn("implied_home_total_at_horizon", home)
        .withColumnRenamed("spread_at_horizon_available", "market_available_at_horizon")
        .drop("win_prob_at_horizon_available", "total_at_horizon_available")
        .withColumn("cv_split", temporal_split("season", *SPLIT))
    )


# What of the weather is known at a horizon only as a forecast.
HORIZON_WEATHER = (
    "eff_temp_f eff_wind_mph eff_precip_in wind_bucket temp_bucket adverse_weather_score passing_condition_score "
    "cold_wind_interaction weather_source_type forecast_run_ts"
)


@MARTS.relation(
    "mart_backtest_game", "int_weather_horizon", key=("game_id", "prediction_horizon"),
    materialise=True, partition=("season",), stay=True,
)
def mart_backtest_game_forecast(backtest: DataFrame, weather: DataFrame) -> DataFrame:
    """The backtest with the weather forecast at each horizon in place of the weather that came; NULL where no run was known yet."""
    shown = HORIZON_WEATHER.split()
    held = weather.select("game_id", "prediction_horizon", *shown)
    out = backtest.drop(*shown).join(held, ["game_id", "prediction_horizon"], "left")
    return out.select(*backtest.columns)


PLAYER_BACKTEST = (
    "player_id full_name position position_group team opponent season week game_id home_flag targets_per_game_std "
    "rec_per_game_std rec_yds_per_game_std target_share_std air_yards_share_std wopr_std snap_pct_std carries_per_game_std "
    "rush_yds_per_game_std rush_tds_per_game_std attempts_per_game_std pass_yds_per_game_std pass_tds_per_game_std "
    "games_played_std targets_per_game_l4 target_share_l4 carries_per_game_l4 targets_per_game_l2 carries_per_game_l2 "
    "team_epa_blended team_pass_rate_std team_pts_for_std opp_def_epa_blended opp_def_pass_epa_std opp_def_rush_epa_std "
    "opp_cb_burden opp_dl_burden injury_status injury_out_flag actual_targets actual_receptions actual_rec_yards actual_rec_tds "
    "actual_carries actual_rush_yards actual_rush_tds actual_pass_attempts actual_pass_yards actual_pass_tds actual_fpts_std "
    "actual_fpts_ppr"
)


@MARTS.relation(
    "mart_player_week_projection", "int_weather_game", "mart_game_modeling", key=("season", "week", "player_id", "prediction_horizon")
)
def mart_backtest_player(players, weather, games) -> DataFrame:
    base = _played(players).select(*PLAYER_BACKTEST.split())
    shown = (
        "eff_temp_f eff_wind_mph eff_precip_in wind_bucket adverse_weather_score passing_condition_score "
        "total_suppression_score roof_closed_flag weather_source_type"
    )
    out = assemble(
        base,
        [by_game(weather, keep(shown)), by_game(games, keep("opening_home_team_total opening_away_team_total", "__"))],
    )
    implied = pick_by_role("home_flag", "__opening_home_team_total", "__opening_away_team_total")
    out = out.withColumns(
        {"team_implied_total_opening": implied, "cv_split": temporal_split("season", *SPLIT)}
    ).drop("__opening_home_team_total", "__opening_away_team_total")
    return horizons.expand(out).drop("hours_before_event")
