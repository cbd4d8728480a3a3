"""Joins by role, alternative key, validity range, previous period and fallback key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def role_join(
    df: DataFrame,
    side: DataFrame,
    on: Mapping[str, str],
    key: str,
    measures: Sequence[str],
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Join the same relation once per role: `on` is {role: key column in df}.

    Measures arrive as `{role}_{measure}`. `side` must be unique per key and extra keys.
    """
    for role, col in on.items():
        names = {key: col, **{m: f"{role}_{m}" for m in measures}}
        part = side.select(*extra_keys, *[F.col(c).alias(n) for c, n in names.items()])
        df = df.join(part, [col, *extra_keys], "left")
    return df


def either_key_join(
    df: DataFrame,
    side: DataFrame,
    key: str,
    candidates: Sequence[str],
    extra_keys: Sequence[str] = (),
    how: str = "inner",
    row_id: Sequence[str] = (),
) -> DataFrame:
    """Join where `key` equals any of the candidate columns, as a plain equi-join.

    The candidates of a row are exploded without repeats, so a row whose candidates coincide
    matches once. With `how="left"` name a unique `row_id`: rows with no match come back once.
    """
    choices = F.array_distinct(F.filter(F.array(*candidates), lambda c: c.isNotNull()))
    exploded = df.withColumn(key, F.explode(choices))
    matched = exploded.join(side, [key, *extra_keys], "inner")
    if how == "inner":
        return matched
    if not row_id:
        raise ValueError("a left join needs row_id")
    missing = df.join(matched.select(*row_id), list(row_id), "left_anti")
    return matched.unionByName(missing, allowMissingColumns=True)


LEVELS = 16  # widths of interval bins: 16 to the level, up to what a long holds
OPEN = LEVELS  # the level of ranges without end


def _ordinal(value: Column, kind: str) -> Column:
    """A number whose order is that of the values, for dates, instants and numbers."""
    if kind == "date":
        return F.unix_date(value).cast("bigint")
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp"))
    return F.floor(value).cast("bigint")


def _bin(level: int, value: Column) -> Column:
    return F.lit(0).cast("bigint") if level == OPEN else F.shiftright(value, 4 * level)


def interval_bins(dim: DataFrame, start: str, end: str) -> DataFrame:
    """The rows of a dimension once for each bin their range touches: one or two, as wide as the range or up to 16 times wider."""
    kind = dim.schema[start].dataType.simpleString()
    low, high = _ordinal(F.col(start), kind), _ordinal(F.col(end), dim.schema[end].dataType.simpleString())
    length = high.cast("double") - low.cast("double")
    level, bins = F.lit(OPEN), F.array(F.lit(0).cast("bigint"))
    for k in reversed(range(LEVELS)):
        fits = F.col(end).isNotNull() & (length < float(16**k))
        level = F.when(fits, k).otherwise(level)
        bins = F.when(fits, F.array_distinct(F.array(_bin(k, low), _bin(k, high)))).otherwise(bins)
    real = dim.where(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) <= F.col(end))))
    return real.select("*", level.alias("__level"), F.explode(bins).alias("__bin"))


def _candidates(asked: DataFrame, dim: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """(key, at) with every range of the key that shares a bin, before the range itself is looked at."""
    binned = interval_bins(dim, start, end)
    # The widths there are, at most LEVELS + 1. A question looks into one bin of each.
    levels = binned.agg(F.sort_array(F.collect_set("__level"))).scalar()
    place = _ordinal(F.col("__at"), asked.schema["__at"].dataType.simpleString())
    spots = F.array(*[_bin(k, place) for k in range(LEVELS + 1)])
    asked = asked.select(*keys, "__at", F.explode(levels).alias("__level"), spots.alias("__spots"))
    asked = asked.select(*keys, "__at", "__level", F.get("__spots", F.col("__level")).alias("__bin"))
    return asked.join(binned, [*keys, "__level", "__bin"]).drop("__level", "__bin")


def validity_join(
    df: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    at: str | Column,
    start: str = "season_start",
    end: str = "season_end",
    how: str = "left",
) -> DataFrame:
    """Join a dimension row whose inclusive [start, end] range holds `at`. A NULL `end` means open.

    Each distinct (key, at) is looked up once, in bins: a range lies in the one or two bins of its own width that it touches,
    and a question looks into one bin of every width that occurs, by equality of key, width and bin. So a key with many
    versions pairs a question with the few around it, not with all. The answers come back in a plain equi-join,
    whose skew Spark splits. Nothing is counted beforehand.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.withColumn("__at", F.col(at) if isinstance(at, str) else at)
    kept = [c for c in dim.columns if c not in keys]
    side = dim.select(*keys, *[F.col(c).alias(f"__d_{c}") for c in kept])
    low, high = F.col(f"__d_{start}"), F.col(f"__d_{end}")
    found = _candidates(rows.select(*keys, "__at").dropna().distinct(), side, keys, f"__d_{start}", f"__d_{end}")
    found = found.where((low <= F.col("__at")) & (F.col("__at") <= F.coalesce(high, F.col("__at"))))
    answers = found.select(*[F.col(c).alias(f"__k_{c}") for c in [*keys, "__at"]], *[F.col(f"__d_{c}").alias(c) for c in kept])
    same = F.lit(True)
    for c in [*keys, "__at"]:
        same = same & (rows[c] == answers[f"__k_{c}"])
    return rows.join(answers, same, how).drop("__at", *[f"__k_{c}" for c in [*keys, "__at"]])


def prior_period(
    df: DataFrame, agg: DataFrame, keys: Sequence[str], period: str, how: str = "left"
) -> DataFrame:
    """Join the aggregate of the period just before: the key is shifted, then equi-joined."""
    shifted = agg.withColumn(period, F.col(period) + 1)
    return df.join(shifted, [*keys, period], how)


def fill_key(df: DataFrame, lookup: DataFrame, on: Sequence[str], key: str, deal: Column | None = None) -> DataFrame:
    """Fill a missing key from a lookup; a key already present wins. One lookup row per `on` is used.

    Only rows without a key are exchanged for the join. With `deal` they are dealt by it afterwards, to where the others are.
    """
    one = lookup.filter(F.col(key).isNotNull()).groupBy(*on).agg(F.min(key).alias(key))
    missing = df.filter(F.col(key).isNull()).drop(key).join(one, list(on), "left")
    if deal is not None:
        missing = missing.repartition(deal)
    return df.filter(F.col(key).isNotNull()).unionByName(missing)


def unique_left(df: DataFrame, side: DataFrame, on: Sequence[str], keep_order: Sequence[Column]) -> DataFrame:
    """Left join that cannot fan out: the side keeps one row per key, the least in `keep_order`.

    `keep_order` must decide between any two rows of a key.
    """
    rest = [c for c in side.columns if c not in on]
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(keep_order)])
    one = side.groupBy(*on).agg(F.min_by(F.struct(*rest), rank).alias("__row"))
    return df.join(one, list(on), "left").select(*df.columns, "__row.*")
