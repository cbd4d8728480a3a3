"""Distances and travel between places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.clocks import utc_offset_hours
from leaksafe.functions.features import _c

EARTH_KM = 6371.0


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km."""
    lat1, lon1, lat2, lon2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2.0)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2.0)
    )
    return F.lit(2 * EARTH_KM) * F.atan2(F.sqrt(half), F.sqrt(1 - half))


def expand_validity(df: DataFrame, start: str, end: str, first: int, last: int, out: str = "season") -> DataFrame:
    """One row per period in which a validity range is open, clipped to [first, last]."""
    low = F.greatest(F.col(start), F.lit(first))
    high = F.least(F.coalesce(F.col(end), F.lit(last)), F.lit(last))
    return df.filter(low <= high).withColumn(out, F.explode(F.sequence(low, high)))


def travel_columns(
    df: DataFrame, *, at: str = "2023-11-01 12:00:00", lat_gap: float = 20.0, lon_gap: float = 50.0
) -> DataFrame:
    """Distance, zone shift and direction flags of a trip from the `away_` to the `home_` place.

    Expects `{home,away}_{lat,lon,tz}`. The international flag is a rule on coordinate gaps.
    """
    moment = F.lit(at).cast("timestamp")
    shift = utc_offset_hours("home_tz", moment) - utc_offset_hours("away_tz", moment)
    far = (F.abs(F.col("home_lat") - F.col("away_lat")) > lat_gap) | (
        F.abs(F.col("home_lon") - F.col("away_lon")) > lon_gap
    )
    return df.withColumns(
        {
            "travel_km": haversine("away_lat", "away_lon", "home_lat", "home_lon"),
            "timezone_shift_hours": shift,
            "east_to_west_flag": F.when(shift < -1, 1).otherwise(0),
            "west_to_east_flag": F.when(shift > 1, 1).otherwise(0),
            "international_travel_flag": F.when(far, 1).otherwise(0),
        }
    )


def _roles(places: DataFrame, period: Sequence[str], role: str) -> DataFrame:
    return places.select(
        *period,
        F.col("team").alias(f"{role}_team"),
        F.col("latitude").alias(f"{role}_lat"),
        F.col("longitude").alias(f"{role}_lon"),
        F.col("timezone").alias(f"{role}_tz"),
    )


def pair_distances(pairs: DataFrame, places: DataFrame, period: Sequence[str] = ("season",), **rules) -> DataFrame:
    """Travel for the (home_team, away_team, period) pairs that occur: two lookups, no pairing of places.

    `places` holds team, latitude, longitude, timezone per period.
    """
    period = list(period)
    wanted = pairs.select(*period, "home_team", "away_team").distinct()
    out = wanted.join(_roles(places, period, "home"), [*period, "home_team"], "left")
    out = out.join(_roles(places, period, "away"), [*period, "away_team"], "left")
    return travel_columns(out, **rules)
