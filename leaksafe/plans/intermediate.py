"""Intermediate relations: rest, team and player games, form, injuries, market, rating, weather, travel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import bucketize, capped_score, flag, override, ratio
from leaksafe.functions.odds import crossed, movement
from leaksafe.operators import asof, clean, events, horizons, joins, reshape, rolling, schedule
from leaksafe.operators.events import Agg
from leaksafe.operators.quality import with_zone
from leaksafe.operators.ratings import affine_rating
from leaksafe.operators.windows import Frame, Running, ordered, profile
from leaksafe.plans.catalog import Catalog
from leaksafe.plans.staging import DEFAULT_REST, LINE_TIE, POSITION_GROUPS, weather_at_kickoff

INTERMEDIATE = Catalog()

TEAM_WEEK = ["week", "game_id"]  # the game id breaks ties of a duplicated week
# Weather thresholds (mph, °F, inches, percent).
WIND = {"wind_10_flag": 10, "wind_15_flag": 15, "wind_20_flag": 20, "wind_25_flag": 25}
COLD_F, VERY_COLD_F, HOT_F, PRECIP_IN, SNOW_IN, HUMID_PCT = 32, 20, 85, 1.0, 0.5, 80
# Explosive plays by yards gained.
EXPLOSIVE_PASS, EXPLOSIVE_RUSH = 20, 10
INJURY_GROUPS = ("QB", "OL", "WR", "TE", "RB", "DL", "LB", "CB", "S")


@INTERMEDIATE.relation("stg_games", "stg_team_week", key=("game_id",), materialise=True, partition=("season",), deal=("game_id",))
def int_game_base(games: DataFrame, sides: DataFrame) -> DataFrame:
    regular = sides.filter("season_type = 'regular'")
    spots = schedule.gaps(regular, ["team", "season"], TEAM_WEEK, "game_date")
    # Both sides of a game onto one row: one aggregation instead of two joins.
    wanted = {"rest_days": "days_since_last", "bye_prior": "opener_flag", "short_week": "short_gap_flag"}
    picks = [
        F.max(F.when(F.col("home_flag") == value, F.col(source))).alias(f"{side}_{out}")
        for side, value in (("home", 1), ("away", 0))
        for out, source in wanted.items()
    ]
    rest = spots.groupBy("game_id").agg(*picks)
    full = lambda c: F.coalesce(F.col(c), F.lit(DEFAULT_REST))
    return (
        games.drop("home_rest_days", "away_rest_days")
        .join(rest, "game_id", "left")
        .withColumn("rest_days_advantage_home", full("home_rest_days") - full("away_rest_days"))
        .select(
            "game_id", "season", "week", "season_type", "game_date", "kickoff_time_local", "weekday", "home_team", "away_team",
            "home_score", "away_score", "total_points", "home_margin", "home_win_flag", "game_completed_flag", "stadium",
            "surface", "roof", "location", "div_game", "conf_game", "primetime_flag",
            *rest.columns[1:], "rest_days_advantage_home", "pfr_game_id", "espn_game_id", "nfl_detail_id",
        )
    )


def _team_measures() -> tuple[dict, dict]:
    is_pass, is_rush = F.col("pass_attempt") == 1, F.col("rush_attempt") == 1
    zone = F.col("red_zone_flag") == 1
    score = zone & (F.col("touchdown") == 1)
    lost = F.coalesce("interception", F.lit(0)) + F.coalesce("fumble_lost", F.lit(0))
    success = F.col("success").cast("double")
    big_pass = is_pass & (F.col("yards_gained") >= EXPLOSIVE_PASS)
    big_rush = is_rush & (F.col("yards_gained") >= EXPLOSIVE_RUSH)
    own = {
        "offensive_plays": Agg("count"),
        "pass_attempts": Agg("sum", "pass_attempt"),
        "rush_attempts": Agg("sum", "rush_attempt"),
        "total_yards": Agg("sum", "yards_gained"),
        "epa_per_play": Agg("avg", "epa"),
        "total_epa": Agg("sum", "epa"),
        "pass_epa_per_dropback": Agg("avg", "epa", is_pass),
        "rush_epa_per_carry": Agg("avg", "epa", is_rush),
        "success_rate": Agg("avg", success),
        "pass_success_rate": Agg("avg", success, is_pass),
        "rush_success_rate": Agg("avg", success, is_rush),
        "explosive_pass_rate": Agg("rate", big_pass),
        "explosive_rush_rate": Agg("rate", big_rush),
        "avg_air_yards": Agg("avg", "air_yards", is_pass),
        "red_zone_plays": Agg("count", None, zone),
        "red_zone_tds": Agg("count", None, score),
        "interceptions_thrown": Agg("sum", "interception"),
        "fumbles_lost": Agg("sum", "fumble_lost"),
        "turnovers": Agg("sum", lost),
        "sacks_allowed": Agg("sum", "sack"),
    }
    other = {
        "def_epa_per_play": Agg("avg", "epa"),
        "def_total_epa": Agg("sum", "epa"),
        "def_success_rate_allowed": Agg("avg", success),
        "def_pass_epa_per_dropback": Agg("avg", "epa", is_pass),
        "def_rush_epa_per_carry": Agg("avg", "epa", is_rush),
        "def_turnovers_forced": Agg("sum", lost),
        "def_sacks": Agg("sum", "sack"),
        "def_explosive_pass_rate_allowed": Agg("rate", big_pass),
        "def_red_zone_tds_allowed": Agg("count", None, score),
    }
    return own, other


@INTERMEDIATE.relation(
    "stg_team_week", "stg_plays", key=("game_id", "team"), materialise=True, partition=("season",), stay=True, deal=("game_id",)
)
def int_team_game(sides: DataFrame, plays: DataFrame) -> DataFrame:
    scrimmage = plays.filter(F.col("play_type").isin("pass", "run") & (F.col("season_type") == "regular"))
    own, other = _team_measures()
    rolled = events.two_sided_rollup(scrimmage, ["game_id"], "posteam", "defteam", own, other, entity="team")
    rolled = rolled.withColumns(
        {
            "red_zone_td_rate": ratio("red_zone_tds", "red_zone_plays"),
            "pass_rate": ratio("pass_attempts", F.col("pass_attempts") + F.col("rush_attempts")),
        }
    )
    return sides.drop("game_type").join(rolled, ["game_id", "team"], "left")


# Team form: output stem → measure of the team game.
FORM_STD = {
    "epa_pp_std": "epa_per_play", "pass_epa_std": "pass_epa_per_dropback", "rush_epa_std": "rush_epa_per_carry",
    "def_epa_pp_std": "def_epa_per_play", "def_pass_epa_std": "def_pass_epa_per_dropback",
    "def_rush_epa_std": "def_rush_epa_per_carry", "success_rate_std": "success_rate",
    "pass_success_rate_std": "pass_success_rate", "rush_success_rate_std": "rush_success_rate",
    "def_success_rate_allowed_std": "def_success_rate_allowed", "explosive_pass_rate_std": "explosive_pass_rate",
    "explosive_rush_rate_std": "explosive_rush_rate", "pass_rate_std": "pass_rate", "turnovers_per_game_std": "turnovers",
    "def_to_forced_std": "def_turnovers_forced", "sacks_allowed_std": "sacks_allowed", "def_sacks_std": "def_sacks",
    "rz_td_rate_std": "red_zone_td_rate", "pts_for_std": "points_for", "pts_against_std": "points_against",
}
FORM_L5 = {
    "epa_pp_l5": "epa_per_play", "pass_epa_l5": "pass_epa_per_dropback", "rush_epa_l5": "rush_epa_per_carry",
    "def_epa_pp_l5": "def_epa_per_play", "success_rate_l5": "success_rate", "def_success_rate_l5": "def_success_rate_allowed",
    "turnovers_l5": "turnovers", "pts_for_l5": "points_for", "pts_against_l5": "points_against",
}
FORM_L3 = {
    "epa_pp_l3": "epa_per_play", "pass_epa_l3": "pass_epa_per_dropback", "def_epa_pp_l3": "def_epa_per_play",
    "pts_for_l3": "points_for", "pts_against_l3": "points_against",
}
PRIOR = {
    "prior_epa_pp": "epa_per_play", "prior_def_epa_pp": "def_epa_per_play", "prior_success_rate": "success_rate",
    "prior_pass_rate": "pass_rate",
}


def lagged_means(windows: Sequence[tuple[dict, int | None]]) -> dict:
    """Window outputs for {output: column} mappings, each over its number of earlier rows."""
    out = {}
    for columns, n in windows:
        for name, col in columns.items():
            value = F.col(col).cast("double")
            out[name] = Running("avg", value) if n is None else Frame("avg", value, -n, -1)
    return out


@INTERMEDIATE.relation("int_team_game", key=("season", "week", "team"), materialise=True, partition=("season",), deal=("team", "season"))
def int_team_form(games: DataFrame) -> DataFrame:
    regular = games.filter("season_type = 'regular'")
    outputs = {
        "game_num_in_season": Running("count", None, inclusive=True),
        **lagged_means([(FORM_STD, None), (FORM_L5, 5), (FORM_L3, 3)]),
        "games_played_std": Running("count"),
        "wins_l5": Frame("sum", "win_flag", -5, -1),
    }
    form = ordered(regular, ["team", "season"], TEAM_WEEK, outputs).select(
        "team", "season", "week", "game_id", "game_date", "points_for", "points_against", "margin", "win_flag", *outputs
    )
    prior = rolling.prior_period_avg(regular, ["team"], "season", PRIOR)
    out = form.join(prior, ["team", "season"], "left")
    return out.withColumns(
        {
            f"{m}_blended": rolling.blend_prior(f"{m}_std", f"prior_{m}", "games_played_std")
            for m in ("epa_pp", "def_epa_pp")
        }
    )


@INTERMEDIATE.relation("stg_injuries_weekly", key=("season", "week", "team"), materialise=True, partition=("season",))
def int_injury_team_impact(injuries: DataFrame) -> DataFrame:
    status = F.upper("report_status")
    no_special = {p: g for p, g in POSITION_GROUPS.items() if g not in ("K", "P")}
    group = F.coalesce(clean.remap_expr(F.upper("position"), no_special, "OTHER"), F.lit("OTHER"))
    limited = injuries.withColumns({"status": status, "position_group": group}).filter(F.col("status") != "FULL")

    def count(value: str):
        return lambda here: F.count_if(here & (F.col("status") == value))

    burden = lambda here: F.sum(F.when(here, F.col("injury_severity_score")))
    measures = {
        "out": count("OUT"), "doubtful": count("DOUBTFUL"), "questionable": count("QUESTIONABLE"), "burden": burden,
    }
    keys = ["team", "season", "week"]
    # Per group the counts are sums over disjoint rows, so one level of grouping is enough.
    total = {"total_injury_burden": F.sum("injury_severity_score")}
    wide = reshape.pivot_measures(limited, keys, "position_group", INJURY_GROUPS, measures, extra=total)
    kept = []
    for g in INJURY_GROUPS:
        names = ("out", "doubtful", "questionable", "burden") if g in ("QB", "WR") else ("out", "burden")
        kept += [F.col(f"{g}_{m}").alias(f"{g.lower()}_{m}") for m in names]
    return wide.select(*keys, "total_injury_burden", *kept)


PLAYER_GAME = (
    "completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks", "passing_air_yards", "passing_yac",
    "passing_epa", "dakota", "carries", "rushing_yards", "rushing_tds", "rushing_epa", "targets", "receptions",
    "receiving_yards", "receiving_tds", "receiving_air_yards", "receiving_yac", "receiving_epa", "target_share",
    "air_yards_share", "wopr", "racr", "fantasy_points_std", "fantasy_points_ppr",
)
PLAYER_RATIOS = {
    "comp_pct": ("completions", "attempts"), "yards_per_attempt": ("passing_yards", "attempts"),
    "yards_per_carry": ("rushing_yards", "carries"), "catch_rate": ("receptions", "targets"),
    "yards_per_target": ("receiving_yards", "targets"),
}


@INTERMEDIATE.relation("stg_player_week", "stg_games", "stg_snap_counts_weekly", key=("season", "week", "player_id"), materialise=True, partition=("season",), stay=True)
def int_player_game(players: DataFrame, games: DataFrame, snaps: DataFrame) -> DataFrame:
    held = games.filter(F.col("season_type").isin("regular", "postseason")).select(
        "game_id", "game_date", "season", "week", "home_team", "away_team"
    )
    # "team is home or away" as an equi-join: each game once per distinct side.
    sides = held.withColumn("team", F.explode(F.array_distinct(F.array("home_team", "away_team"))))
    rows = players.join(sides, ["season", "week", "team"], "left")
    snaps = snaps.select("season", "week", "team", "full_name", "offense_snaps", "offense_snap_pct", "pfr_player_id")
    # Names are not unique: one snap row per name, so no player is doubled.
    rows = joins.unique_left(rows, snaps, ["season", "week", "team", "full_name"], [F.col("pfr_player_id")])
    return rows.select(
        "player_id", "full_name", "position", "position_group", "team", "opponent", "season", "week", "season_type", "game_id",
        "game_date", "home_team", "away_team", flag(F.col("team") == F.col("home_team")).alias("home_flag"), *PLAYER_GAME,
        *[ratio(n, d).alias(out) for out, (n, d) in PLAYER_RATIOS.items()], "offense_snaps", "offense_snap_pct",
    )


PLAYER_STD = {
    "targets_per_game": "targets", "rec_per_game": "receptions", "rec_yds_per_game": "receiving_yards",
    "rec_tds_per_game": "receiving_tds", "target_share": "target_share", "air_yards_share": "air_yards_share", "wopr": "wopr",
    "snap_pct": "offense_snap_pct", "carries_per_game": "carries", "rush_yds_per_game": "rushing_yards",
    "rush_tds_per_game": "rushing_tds", "attempts_per_game": "attempts", "pass_yds_per_game": "passing_yards",
    "pass_tds_per_game": "passing_tds", "rec_epa_per_game": "receiving_epa", "rush_epa_per_game": "rushing_epa",
    "pass_epa_per_game": "passing_epa",
}
PLAYER_L4 = (
    "targets_per_game", "rec_per_game", "rec_yds_per_game", "target_share", "snap_pct", "carries_per_game",
    "rush_yds_per_game", "attempts_per_game", "pass_yds_per_game",
)
PLAYER_L2 = ("targets_per_game", "rec_yds_per_game", "carries_per_game")


@INTERMEDIATE.relation("int_player_game", key=("season", "week", "player_id"))
def int_player_form(games: DataFrame) -> DataFrame:
    regular = games.filter(F.col("season_type").isin("REG", "regular") & F.col("player_id").isNotNull())
    outputs = {
        "game_num": Running("count", None, inclusive=True),
        **lagged_means(
            [
                ({f"{o}_std": c for o, c in PLAYER_STD.items()}, None),
                ({f"{o}_l4": PLAYER_STD[o] for o in PLAYER_L4}, 4),
                ({f"{o}_l2": PLAYER_STD[o] for o in PLAYER_L2}, 2),
            ]
        ),
        "games_played_std": Running("count"),
    }
    return ordered(regular, ["player_id", "season"], TEAM_WEEK, outputs).select(
        "player_id", "full_name", "position", "position_group", "team", "season", "week", *outputs
    )


QB_COLUMNS = (
    "completions", "attempts", "passing_yards", "passing_tds", "interceptions", "sacks", "passing_air_yards", "passing_epa",
    "dakota", "comp_pct", "yards_per_attempt",
)
MIN_QB_ATTEMPTS = 5


@INTERMEDIATE.relation("int_player_game", "int_team_game", "int_injury_team_impact", key=("game_id", "player_id"))
def int_qb_team_context(players: DataFrame, teams: DataFrame, injuries: DataFrame) -> DataFrame:
    rows = players.filter((F.col("position") == "QB") & (F.col("attempts") >= MIN_QB_ATTEMPTS))
    own = teams.select(
        "game_id", "team", "pass_rate", "offensive_plays", F.col("pass_epa_per_dropback").alias("team_pass_epa"),
        F.col("sacks_allowed").alias("oline_sacks_allowed"),
    )
    other = teams.select(
        "game_id", F.col("team").alias("opponent"), F.col("def_sacks").alias("opp_def_sacks"),
        F.col("def_pass_epa_per_dropback").alias("opp_def_pass_epa"),
    )
    hurt = injuries.select("team", "season", "week", "wr_burden", "te_burden", "wr_out", "te_out")
    rows = rows.join(own, ["game_id", "team"], "left").join(other, ["game_id", "opponent"], "left")
    rows = rows.join(hurt, ["team", "season", "week"], "left")
    zero = F.lit(0)
    return rows.select(
        "game_id", "player_id", "full_name", "team", "opponent", "season", "week", "home_flag", "game_date", *QB_COLUMNS,
        F.col("carries").alias("qb_carries"), F.col("rushing_yards").alias("qb_rush_yards"),
        F.col("rushing_tds").alias("qb_rush_tds"), "pass_rate", "offensive_plays", "team_pass_epa", "oline_sacks_allowed",
        "opp_def_sacks", "opp_def_pass_epa",
        (F.coalesce("wr_burden", zero) + F.coalesce("te_burden", zero)).alias("skill_position_injury_burden"),
        "wr_out", "te_out",
    )


@INTERMEDIATE.relation(
    "stg_market_game_line", "stg_market_close_game", "stg_market_consensus_game",
    key=("game_id", "market_type", "selection"), materialise=True, partition=("season",), stay=True, deal=("game_id",),
)
def int_market_open_close(lines: DataFrame, closes: DataFrame, consensus: DataFrame) -> DataFrame:
    """Opening against closing line. Markets without a close stay, with NULL."""
    market = ["game_id", "market_type", "selection"]
    known = F.col("game_id").isNotNull()
    early = lines.filter(F.col("snapshot_type").isin("opening", "intraday") & known)
    opens = asof.first_per_key(
        early, ["game_id", "season", "week", "market_type", "selection", "home_team", "away_team"], "market_timestamp_utc",
        LINE_TIE, ["market_timestamp_utc", "line", "price_american", "implied_prob_raw"],
    ).withColumnsRenamed(
        {
            "market_timestamp_utc": "open_timestamp", "line": "opening_line", "price_american": "opening_price",
            "implied_prob_raw": "opening_implied_prob",
        }
    )
    closes = closes.select(
        *market, "closing_line", "closing_price_american", "closing_implied_prob", "close_timestamp", "close_sportsbook"
    )
    closing = consensus.filter(F.col("snapshot_type") == "closing")
    last = asof.last_per_key(
        closing, market, "market_timestamp", ["season", "week"], ["line_stddev", "book_count"]
    ).withColumnsRenamed({"line_stddev": "close_consensus_dispersion", "book_count": "close_book_count"})
    rows = opens.join(closes, market, "left").join(last, market, "left")
    rows = rows.withColumn("__m", movement("opening_line", "closing_line"))
    spread, home = F.col("market_type") == "spread", F.col("selection") == "home"
    opening = F.col("opening_line")
    out = rows.select(
        "game_id", "season", "week", "home_team", "away_team", "market_type", "selection", "opening_line", "opening_price",
        "opening_implied_prob", "open_timestamp", "closing_line", "closing_price_american", "closing_implied_prob",
        "close_timestamp", "close_sportsbook", F.col("__m.move").alias("move_open_to_close"),
        F.col("__m.abs_move").alias("abs_move_open_to_close"), F.col("__m.flip").alias("favorite_flip_flag"),
        *[
            F.when(spread, flag(crossed("opening_line", "closing_line", [k]))).alias(f"crossed_key_{k}_flag")
            for k in (3, 7, 10)
        ],
        F.col("__m.volatility").alias("line_volatility_score"), "close_consensus_dispersion", "close_book_count",
        F.lit(None).cast("double").alias("opening_implied_home_total"),
        flag(spread & home & (opening < 0)).alias("home_fav_opening"),
        flag(spread & home & (opening > 0)).alias("home_dog_opening"),
        flag(spread & (F.col("selection") == "away") & (opening < 0)).alias("road_fav_opening"),
    )
    late = [c for c in out.columns if c.startswith(("clos", "move_", "abs_move", "favorite_flip", "crossed_", "line_vol"))]
    return with_zone(out, dict.fromkeys(late, 3))


@INTERMEDIATE.relation(
    "stg_market_game_line", "stg_weather_game_kickoff", key=("game_id", "market_type", "selection", "time_bucket"),
    materialise=True, partition=("season",), deal=("game_id",),
)
def int_market_time_buckets(lines: DataFrame, kickoffs: DataFrame) -> DataFrame:
    kicked = kickoffs.select("game_id", "kickoff_ts_approx")
    rows = lines.select(
        "game_id", "season", "week", "market_type", "selection", "line", "price_american", "implied_prob_raw",
        "market_timestamp_utc", *LINE_TIE,
    ).join(kicked, "game_id")
    out = horizons.bucket_latest(
        rows, ["game_id", "market_type", "selection"], "market_timestamp_utc", "kickoff_ts_approx", LINE_TIE,
        cols=["season", "week", "line", "price_american", "implied_prob_raw", "market_timestamp_utc"],
    )
    return out.withColumnsRenamed(
        {
            "line": "bucket_line", "price_american": "bucket_price", "implied_prob_raw": "bucket_implied_prob",
            "market_timestamp_utc": "bucket_timestamp", "hours_before": "hours_before_kickoff",
        }
    )


@INTERMEDIATE.relation("int_team_game", "int_team_form", key=("game_id", "team"), materialise=True, partition=("season",), stay=True)
def int_team_power_rating(games: DataFrame, form: DataFrame) -> DataFrame:
    regular = games.filter("season_type = 'regular'").select(
        "game_id", "team", "season", "week", "home_flag", "win_flag"
    )
    order = ["season", "week", "game_id"]
    rated = affine_rating(
        regular, ["team"], order, "season", "win_flag", "home_flag", pre="pre", post="post", hot=profile(regular, ["team", "season"], order)
    )
    attack, defence = F.col("epa_pp_blended"), F.col("def_epa_pp_blended")
    power = form.select(
        "team", "season", "week", attack.alias("offensive_power"), defence.alias("defensive_power"),
        (attack + F.abs(defence)).alias("total_environment_rating"), F.col("pass_epa_std").alias("qb_pass_epa_context"),
        F.col("pass_rate_std").alias("pace_proxy"),
    )
    out = rated.join(power, ["team", "season", "week"]).select(
        "game_id", "team", "season", "week", "home_flag", "win_flag", F.round("pre", 1).alias("elo_rating_pregame"),
        F.round("post", 1).alias("elo_rating_postgame"), "offensive_power", "defensive_power", "total_environment_rating",
        "qb_pass_epa_context", "pace_proxy",
    )
    return with_zone(out, {"elo_rating_postgame": 3})


def game_weather(weather: DataFrame, keys: Sequence[str] = ("game_id",)) -> DataFrame:
    """Effective weather, flags, buckets and scores of each row of kickoff weather."""
    shut = F.col("roof_closed_flag") == 1
    outdoors = F.col("roof_closed_flag") == 0
    temp, wind, rain, snow = (F.col(c) for c in ("temp_f", "wind_mph", "precip_in", "snow_in"))
    chill = F.lit(32.0) - temp
    adverse = capped_score(
        [("wind_mph", 5, 2.5, 40), (chill, 0, 1.0, 25), ("precip_in", 0, 20, 25), ("snow_in", 0, 20, 10)], 100,
        override=(shut, 0),
    )
    against_passing = capped_score([("wind_mph", 5, 3.5, 60), (chill, 0, 0.8, 20), ("precip_in", 0, 15, 20)], 100)
    suppression = flag(wind >= 20) * 2 + flag(temp < 32) + flag(rain > 1)
    flags = {
        "cold_flag": temp < COLD_F, "very_cold_flag": temp < VERY_COLD_F, "hot_flag": temp > HOT_F,
        **{name: wind >= mph for name, mph in WIND.items()},
        "precip_flag": rain > PRECIP_IN, "snow_flag": snow > SNOW_IN, "high_humidity_flag": F.col("humidity_pct") > HUMID_PCT,
    }
    winds = ["calm", "mild_wind", "moderate_wind", "strong_wind", "severe_wind"]
    temps = ["extreme_cold", "freezing", "cold", "cool", "mild", "warm", "hot"]
    return weather.select(
        *keys, "season", "week", "stadium_id", "roof_closed_flag", "open_air_weather_applicable", "weather_source_type",
        "forecast_run_ts", "temp_f", "apparent_temp_f", "wind_mph", "wind_gusts_mph", "wind_dir_deg", "precip_in", "rain_in",
        "snow_in", "snow_depth_in", "humidity_pct", "dew_point_f", "pressure_hpa", "weather_condition",
        override(temp, shut, 72.0).alias("eff_temp_f"), override(wind, shut, 0.0).alias("eff_wind_mph"),
        override(rain, shut, 0.0).alias("eff_precip_in"), override(snow, shut, 0.0).alias("eff_snow_in"),
        *[flag(outdoors & condition).alias(name) for name, condition in flags.items()],
        bucketize(wind, [10, 15, 20, 25], winds, first=(shut, "dome"), otherwise="calm").alias("wind_bucket"),
        bucketize(temp, [20, 32, 45, 55, 70, 85], temps, first=(shut, "dome"), otherwise="hot").alias("temp_bucket"),
        adverse.alias("adverse_weather_score"),
        F.when(shut, 100.0).otherwise(F.greatest(F.lit(0.0), 100 - against_passing)).alias("passing_condition_score"),
        F.when(shut, 0).otherwise(suppression).alias("total_suppression_score"),
        flag(outdoors & (temp < 32) & (wind >= 10)).alias("cold_wind_interaction"),
    )


@INTERMEDIATE.relation("stg_weather_game_kickoff", key=("game_id",), materialise=True, partition=("season",))
def int_weather_game(weather: DataFrame) -> DataFrame:
    out = game_weather(weather)
    # Observed at kickoff, so never known before; only where and under which roof is.
    known = {"game_id", "season", "week", "stadium_id", "roof_closed_flag", "open_air_weather_applicable", "weather_source_type"}
    return with_zone(out, {c: 3 for c in out.columns if c not in known})


@INTERMEDIATE.relation("stg_games", "raw_stadium_metadata", "stg_weather_game_hourly", key=("game_id", "prediction_horizon"))
def int_weather_horizon(games: DataFrame, stadiums: DataFrame, hourly: DataFrame) -> DataFrame:
    """The weather of a game as forecast at each prediction horizon: from runs made before it, so known by then."""
    return game_weather(weather_at_kickoff(games, stadiums, hourly, by_horizon=True), ("game_id", "prediction_horizon", "hours_before_event"))


@INTERMEDIATE.relation(
    "stg_games", "stg_travel_context", "raw_team_timezone_reference", "stg_stadium", key=("game_id", "team")
)
def int_team_travel_game(games: DataFrame, travel: DataFrame, zones: DataFrame, stadiums: DataFrame) -> DataFrame:
    held = games.filter(F.col("season_type").isin("regular", "postseason")).select(
        "game_id", "season", "week", "home_team", "away_team"
    )
    held = held.join(travel.drop("ingestion_ts"), ["season", "home_team", "away_team"], "left")
    venues = stadiums.select(F.col("team").alias("home_team"), "season_start", "season_end", F.col("timezone").alias("game_venue_tz"))
    held = joins.validity_join(held, venues, "home_team", "season").drop("season_start", "season_end")
    zero, none = F.lit(0.0), F.lit(0)
    distance = bucketize("travel_km", [500, 1500, 3000], ["short", "medium", "long", "cross_country"], otherwise="cross_country")
    known = F.col("travel_km").isNotNull()
    away = {
        # Without a travel row the reference cannot name the traveller; the schedule can.
        "team": F.col("away_team"), "game_location_team": F.col("home_team"), "travel_km": F.col("travel_km"),
        "travel_miles": F.col("travel_miles"), "timezone_shift_hours": F.col("timezone_shift_hours"),
        "east_to_west_flag": F.col("east_to_west_flag"), "west_to_east_flag": F.col("west_to_east_flag"),
        "international_travel_flag": F.col("international_travel_flag"), "travel_distance_bucket": distance,
        "west_east_early_flag": flag(known & (F.col("west_to_east_flag") == 1) & (F.col("timezone_shift_hours") >= 2)),
        "intl_travel_flag": F.col("international_travel_flag"),
    }
    home = {
        "team": F.col("home_team"), "game_location_team": F.col("home_team"), "travel_km": zero, "travel_miles": zero,
        "timezone_shift_hours": zero, "east_to_west_flag": none, "west_to_east_flag": none, "international_travel_flag": none,
        "travel_distance_bucket": F.lit("home"), "west_east_early_flag": none, "intl_travel_flag": none,
    }
    rows = reshape.two_sides(held, away, home, flag="is_away_team", keep=["game_id", "season", "week", "game_venue_tz"])
    zones = zones.select("team", "season", F.col("home_timezone").alias("away_team_home_tz"))
    return rows.join(zones, ["team", "season"], "left")


@INTERMEDIATE.relation("stg_team_week", key=("game_id", "team"))
def int_team_schedule_spot(sides: DataFrame) -> DataFrame:
    regular = sides.filter("season_type = 'regular'").withColumn("road", 1 - F.col("home_flag"))
    keys = ["team", "season"]
    hot = profile(regular, keys, TEAM_WEEK)
    rows = schedule.gaps(regular, keys, TEAM_WEEK, "game_date", hot=hot)
    rows = schedule.recent_counts(rows, keys, TEAM_WEEK, "road", out="road_last4", hot=hot)
    rows = schedule.recent_counts(rows, keys, TEAM_WEEK, "home_flag", out="home_last4", hot=hot)
    rows = schedule.streak(rows, keys, TEAM_WEEK, "road", "road_streak_prior", hot=hot)
    rows = schedule.streak(rows, keys, TEAM_WEEK, "home_flag", "home_streak_prior", hot=hot)
    zero = F.lit(0)
    out = rows.select(
        "game_id", "team", "season", "week", "home_flag", "game_date", F.col("days_since_last").alias("rest_days"),
        F.col("opener_flag").alias("season_opener_flag"), F.col("short_gap_flag").alias("short_week_flag"),
        F.col("long_gap_flag").alias("long_rest_flag"), F.col("opener_flag").alias("bye_week_prior_flag"),
        # Games of the kind among the last four, less one: a count, not a streak.
        F.greatest(zero, F.col("road_last4") - 1).alias("consecutive_road_games_prior"),
        F.greatest(zero, F.col("home_last4") - 1).alias("consecutive_home_games_prior"),
        "road_streak_prior", "home_streak_prior",
        flag((F.col("home_flag") == 0) & (F.col("road_last4") >= 3)).alias("third_road_in_four_flag"),
        F.col("road").alias("road_game_flag"),
        F.col("days_until_next").alias("days_until_next_game_DESCRIPTIVE_ONLY"),
    )
    return with_zone(out, {"days_until_next_game_DESCRIPTIVE_ONLY": 3})
