"""Files and payloads as rows: CSV, nested JSON, parallel arrays, alternating rows, external frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leaksafe.functions.clocks import mm_to_inches
from leaksafe.functions.odds import implied_prob, to_decimal
from leaksafe.operators.clean import remap_expr, standardise
from leaksafe.operators.quality import ContractViolation
from leaksafe.operators.reshape import pair_rows, wide_to_long
from leaksafe.operators.windows import global_rank
from leaksafe.sources.tables import with_lineage, write_table

# Payload market keys and their names in the contract.
MARKETS = {"h2h": "moneyline", "spreads": "spread", "totals": "total"}


def csv_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV with header and a given schema; malformed values fail rather than turn into NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def flatten_json(
    df: DataFrame, json_col: str, schema: StructType | str, path: Sequence[str], fields: Mapping[str, str]
) -> DataFrame:
    """One row per innermost element of nested arrays.

    `path` names the arrays from outside in, each relative to the one before ("" if the payload
    itself is the array). `fields` maps an output to `level.field`, with level `root` or an
    array's name.
    """
    current = df.withColumn("root", F.from_json(json_col, schema)).drop(json_col)
    parent = "root"
    for name in path:
        source = F.col(parent) if name == "" else F.col(f"{parent}.{name}")
        level = name or "element"
        current = current.withColumn(level, F.explode(source))
        parent = level
    keep = [c for c in df.columns if c != json_col]
    return current.select(*keep, *[F.col(source).alias(out) for out, source in fields.items()])


def zip_explode(df: DataFrame, arrays: Sequence[str], keep: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """Parallel arrays → rows, aligned by position; shorter and missing arrays are padded with NULL."""
    types = df.schema
    df = df.withColumns({a: F.coalesce(F.col(a), F.array().cast(types[a].dataType)) for a in arrays})
    zipped = F.arrays_zip(*arrays)
    if position:
        rows = df.select(*keep, F.posexplode(zipped).alias(position, "__z"))
        return rows.select(*keep, position, *[F.col(f"__z.{a}").alias(a) for a in arrays])
    rows = df.select(*keep, F.explode(zipped).alias("__z"))
    return rows.select(*keep, *[F.col(f"__z.{a}").alias(a) for a in arrays])


def ingest_external(df: DataFrame, required: Sequence[str], path: str | None = None, partition: Sequence[str] = ("season",)):
    """Accept a frame made elsewhere if it has the required columns; write it if a path is given."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractViolation(f"missing columns: {', '.join(missing)}")
    if path is not None:
        write_table(df, path, partition=[c for c in partition if c in df.columns])
    return df


def load_partitions(
    df: DataFrame, path: str, source: str, kind: str, *, partition: Sequence[str] = ("season",), version: str | None = None, ts=None
) -> str:
    """Stamp lineage and write all partitions of a source at once.

    A source with several kinds of rows lists the kind as a partition column, so one kind never
    overwrites another.
    """
    return write_table(with_lineage(df, source, kind, version, ts=ts), path, partition=partition)


def append_snapshots(df: DataFrame, existing: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Snapshots not yet stored, one per grain: what to append so that history is kept."""
    return df.dropDuplicates(list(grain)).join(existing.select(*grain), list(grain), "left_anti")


def price_columns(df: DataFrame, price: str = "price_american") -> DataFrame:
    """Add the decimal price and raw implied probability of an American price."""
    return df.withColumns({"price_decimal": to_decimal(price), "implied_probability_raw": implied_prob(price)})


_EVENT = """
array<struct<id string, commence_time string, home_team string, away_team string,
  bookmakers array<struct<key string, last_update string,
    markets array<struct<key string, outcomes array<struct<name string, price double, point double>>>>>>>>
"""


def odds_payload(df: DataFrame, json_col: str, rules: Sequence[tuple[str, str]] = (), at: str | Column = "fetched_at") -> DataFrame:
    """A market API payload (events → bookmakers → markets → outcomes) as contract rows.

    Market keys become the contract's names, and an outcome named after a team becomes `home`
    or `away`.
    """
    rows = flatten_json(
        df, json_col, _EVENT, ["", "bookmakers", "markets", "outcomes"],
        {
            "event_id": "element.id", "game_datetime": "element.commence_time", "home_name": "element.home_team",
            "away_name": "element.away_team", "sportsbook": "bookmakers.key", "book_update": "bookmakers.last_update",
            "market_key": "markets.key", "outcome": "outcomes.name", "price_american": "outcomes.price", "line": "outcomes.point",
        },
    )
    at = F.col(at) if isinstance(at, str) else at
    rows = standardise(rows.withColumn("home_team", F.col("home_name")), "home_team", rules)
    rows = standardise(rows.withColumn("away_team", F.col("away_name")), "away_team", rules)
    side = (
        F.when(F.col("outcome") == F.col("home_name"), "home")
        .when(F.col("outcome") == F.col("away_name"), "away")
        .otherwise(F.lower("outcome"))
    )
    rows = rows.withColumns(
        {
            "market_type": remap_expr("market_key", MARKETS),
            "selection": side,
            "game_datetime": F.to_timestamp("game_datetime"),
            "market_timestamp": F.coalesce(F.to_timestamp("book_update"), at),
            "snapshot_type": F.lit("intraday"),
            "price_american": F.col("price_american").cast("int"),
        }
    )
    return price_columns(rows.drop("home_name", "away_name", "market_key", "outcome", "book_update"))


def _contract_rows(games: DataFrame, variants, source: str, book: str) -> DataFrame:
    ids = ["event_id", "game_id", "game_datetime", "home_team", "away_team", "season", "week"]
    rows = wide_to_long(games, ids, variants)
    rows = rows.withColumns({"source_name": F.lit(source), "sportsbook": F.lit(book)})
    return price_columns(rows)


def numbered(df: DataFrame, order: Sequence[str], out: str = "line_no") -> DataFrame:
    """Lines of a file numbered from 1 in a total order, by ranges of it rather than in one task."""
    return global_rank(df, list(order), out, "__total").drop("__total")


def alternating_lines(
    df: DataFrame, line_no: str, season: int, rules: Sequence[tuple[str, str]] = (), *, source="alternating_csv", book="consensus"
) -> DataFrame:
    """Alternating visitor/home rows (date, team, open, close) → one game per pair → four contract rows.

    Rows pair by `line_no`. By the file's convention open and close are the spread on the home
    row and the total on the visitor's row. An unpaired last row is dropped.
    """
    rows = standardise(df.withColumn("season", F.lit(season)), "team", rules)
    games = pair_rows(rows, ["season"], [line_no], ["date", "team", "open", "close"], ("away", "home"))
    day = F.to_date("home_date", "M/d/y")
    games = games.filter(F.col("complete") == 1).withColumns(
        {
            "event_id": F.concat_ws(
                "_", F.col("season").cast("string"), F.date_format(day, "yyyyMMdd"), "home_team", "away_team"
            ),
            "game_id": F.lit(None).cast("string"),
            "game_datetime": day.cast("timestamp"),
            "week": F.lit(None).cast("int"),
        }
    )
    variants = [
        {
            "market_type": F.lit(market),
            "selection": F.lit(selection),
            "line": F.col(f"{role}_{moment}").try_cast("double"),
            "overunder_line": F.col("away_close").try_cast("double"),
            "price_american": F.lit(-110),
            "snapshot_type": F.lit(snapshot),
            "market_timestamp": F.col("game_datetime"),
        }
        for market, selection, role in (("spread", "home", "home"), ("total", "over", "away"))
        for moment, snapshot in (("open", "opening"), ("close", "closing"))
    ]
    return _contract_rows(games, variants, source, book)


def game_lines(df: DataFrame, rules: Sequence[tuple[str, str]] = (), *, source="game_lines", book="consensus") -> DataFrame:
    """One row per game with spread and total → two closing contract rows, from one scan.

    Expects game_id, season, week, gameday, home_team, away_team, spread_line, home_spread_odds,
    over_under_line and the update times of both lines.
    """
    games = standardise(standardise(df, "home_team", rules), "away_team", rules).withColumns(
        {"event_id": F.col("game_id"), "game_datetime": F.col("gameday").cast("timestamp")}
    )
    shared = {"overunder_line": F.col("over_under_line").cast("double"), "snapshot_type": F.lit("closing")}
    variants = [
        {
            "market_type": F.lit("spread"), "selection": F.lit("home"), "line": F.col("spread_line").cast("double"),
            "price_american": F.col("home_spread_odds").cast("int"),
            "market_timestamp": F.col("spread_line_last_updated_at").cast("timestamp"), **shared,
        },
        {
            "market_type": F.lit("total"), "selection": F.lit("over"), "line": F.col("over_under_line").cast("double"),
            "price_american": F.lit(-110),
            "market_timestamp": F.col("over_under_last_updated_at").cast("timestamp"), **shared,
        },
    ]
    return _contract_rows(games, variants, source, book)


_HOURLY = (
    "temperature_2m", "apparent_temperature", "precipitation", "rain", "snowfall", "snow_depth", "weather_code",
    "wind_speed_10m", "wind_direction_10m", "wind_gusts_10m", "relative_humidity_2m", "dew_point_2m", "surface_pressure",
)


def hourly_payload(
    df: DataFrame, json_col: str, keep: Sequence[str], weather_type: str, *, precipitation_unit: str = "inch"
) -> DataFrame:
    """An hourly weather payload of parallel arrays as one row per hour.

    Amounts given in millimetres are converted, so one column never mixes units. A forecast
    carries its `forecast_run_ts` among `keep`.
    """
    arrays = ", ".join(["time: array<string>"] + [f"{h}: array<double>" for h in _HOURLY])
    parsed = df.withColumn("__p", F.from_json(json_col, f"struct<hourly: struct<{arrays}>>"))
    parsed = parsed.select(*keep, "__p.hourly.*")
    rows = zip_explode(parsed, ["time", *_HOURLY], keep)
    rows = rows.withColumns(
        {
            "observation_or_forecast_ts": F.to_timestamp("time"),
            "weather_type": F.lit(weather_type),
            "weather_code": F.col("weather_code").cast("int"),
            "wind_direction_10m": F.col("wind_direction_10m").cast("int"),
        }
    ).drop("time")
    if precipitation_unit == "mm":
        rows = rows.withColumns({c: mm_to_inches(c) for c in ("precipitation", "rain")})
    return rows
