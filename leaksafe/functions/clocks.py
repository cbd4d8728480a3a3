"""Times: epoch differences, local clocks, zone offsets, units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaksafe.functions.features import _c


def epoch(ts) -> Column:
    """Seconds since 1970 as double; timestamps without zone count as UTC (session zone is UTC)."""
    return F.unix_micros(_c(ts).cast("timestamp")) / F.lit(1e6)


def hours_between(later, earlier) -> Column:
    return (epoch(later) - epoch(earlier)) / 3600.0


def minutes_between(later, earlier) -> Column:
    return (epoch(later) - epoch(earlier)) / 60.0


def at_clock(date, clock) -> Column:
    """A date and an 'HH:MM' text → timestamp without zone; NULL for a malformed clock."""
    clock = _c(clock)
    hours = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")
    minutes = F.split_part(clock, F.lit(":"), F.lit(2)).try_cast("int")
    start = _c(date).cast("date").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), hours, minutes, F.lit(0).cast("decimal(18,6)"))


def local_to_utc(ts, zone) -> Column:
    """A wall-clock time in `zone` → UTC instant."""
    return F.to_utc_timestamp(_c(ts).cast("timestamp"), _c(zone))


def utc_offset_hours(zone, at) -> Column:
    """Offset of an IANA zone from UTC, in hours, at a given UTC instant; half-hour zones included."""
    moment = _c(at).cast("timestamp")
    return (F.unix_micros(F.from_utc_timestamp(moment, _c(zone))) - F.unix_micros(moment)) / F.lit(3.6e9)


def km_to_miles(km) -> Column:
    return _c(km) * 0.621371


def mph_to_kmh(mph) -> Column:
    return _c(mph) * 1.60934


def mm_to_inches(mm) -> Column:
    return _c(mm) / 25.4
