"""Entity look-ups: lists, career and period totals, logs, search.

Filters on the entity and the period reach the scan, so a table partitioned by period and
sorted by entity is pruned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import _c


def share(num: Column, den: Column, digits: int, scale: float = 1.0) -> Column:
    """Rounded ratio of two aggregates, NULL where the denominator is 0."""
    value = num.cast("double") / F.nullif(den, F.lit(0))
    return F.round(value * scale if scale != 1.0 else value, digits)


def entities(
    facts: DataFrame,
    dim: DataFrame | None,
    key: str,
    names: Sequence[str],
    period: str,
    latest: str,
    points: str,
    *,
    attributes: Sequence[str] = (),
    min_points: float = 50,
    group: tuple[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Entities with first and latest period and total points above a minimum, by name.

    `group=(column, values)` keeps some groups only. Facts are aggregated before the dimension
    is joined.
    """
    if group is not None:
        facts = facts.filter(F.col(group[0]).isin(list(group[1])))
    totals = (
        facts.groupBy(key, *names)
        .agg(
            F.max(period).alias(f"latest_{period}"),
            F.min(period).alias(f"first_{period}"),
            F.max(latest).alias(f"latest_{latest}"),
            F.sum(points).alias("career_points"),
        )
        .filter(F.col("career_points") > min_points)
    )
    if dim is not None:
        totals = totals.join(dim.select(key, *attributes), key, "left")
    return totals.orderBy(names[0] if names else key, key)


def career(
    df: DataFrame, by: Sequence[str], games: str, totals: Mapping[str, Column], *, entity: Column | None = None
) -> DataFrame:
    """Totals per period (and other grouping columns): distinct games and any aggregate columns."""
    rows = df if entity is None else df.filter(entity)
    return (
        rows.groupBy(*by)
        .agg(F.count_distinct(games).alias("games"), *[c.alias(n) for n, c in totals.items()])
        .orderBy(*by)
    )


def log(df: DataFrame, where: Column, order: Sequence[str], cols: Mapping[str, object]) -> DataFrame:
    """Rows of one entity and period, in order, with the given (rounded) columns."""
    return df.filter(where).select(*[_c(c).alias(n) for n, c in cols.items()]).orderBy(*order)


def season_average(df: DataFrame, where: Column, games: str, sums: Sequence[str], means: Mapping[str, tuple[str, int]]):
    """One row: distinct games, sums and rounded means `{out: (col, digits)}`."""
    return df.filter(where).agg(
        F.count_distinct(games).alias("weeks"),
        *[F.sum(c).alias(c) for c in sums],
        *[F.round(F.avg(c), digits).alias(out) for out, (c, digits) in means.items()],
    )


def periods(df: DataFrame, period: str, where: Column | None = None) -> DataFrame:
    """Distinct periods, latest first."""
    rows = df if where is None else df.filter(where)
    return rows.select(period).distinct().orderBy(F.col(period).desc())


def career_summary(career_table: DataFrame, sums: Sequence[str], points: str, where: Column | None = None) -> DataFrame:
    """One row over a career table: games, sums, points and points per game."""
    rows = career_table if where is None else career_table.filter(where)
    games, total = F.sum("games"), F.sum(points)
    return rows.agg(
        games.alias("games"),
        *[F.sum(c).alias(c) for c in sums],
        total.alias(points),
        F.when(games > 0, total.cast("double") / games).otherwise(F.lit(0.0)).alias(f"{points}_per_game"),
    )


def season_summary(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, total, mean and best of a value."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias(f"total_{value}"),
        F.avg(value).alias(f"avg_{value}"),
        F.max(value).alias(f"max_{value}"),
    )


def search(df: DataFrame, col: str, term: str) -> DataFrame:
    """Rows whose text contains the term, ignoring case; a missing text never matches."""
    return df.filter(F.lower(F.col(col)).contains(term.lower()))
