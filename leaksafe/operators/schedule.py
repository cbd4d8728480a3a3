"""Gaps, recent counts and streaks along an entity's schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import flag as as_flag
from leaksafe.operators.windows import Frame, HotKeys, Running, ordered


def gaps(
    df: DataFrame, keys, order: Sequence[str], date: str, *, short: int = 6, long: int = 10, hot: HotKeys | None = None
) -> DataFrame:
    """Days since the previous row, opener/short/long flags and days to the next row.

    `days_until_next` looks ahead: it is tagged zone 3 and must not feed a model.
    """
    out = ordered(
        df, keys, order,
        {"__prev": Frame("first", date, -1, -1), "__next": Frame("first", date, 1, 1)},
        hot=hot,
    )
    since = F.datediff(F.col(date), F.col("__prev"))
    out = out.withColumns(
        {
            "days_since_last": since,
            "opener_flag": as_flag(F.col("__prev").isNull()),
            "short_gap_flag": as_flag(since <= short),
            "long_gap_flag": as_flag(since >= long),
            "days_until_next": F.datediff(F.col("__next"), F.col(date)),
        }
    ).drop("__prev", "__next")
    return out.withMetadata("days_until_next", {"zone": 3})


def recent_counts(df: DataFrame, keys, order, flag: str, n: int = 4, out: str | None = None, *, hot=None) -> DataFrame:
    """How often the flag was 1 in the last n rows, the current one included."""
    return ordered(df, keys, order, {out or f"{flag}_last{n}": Frame("sum", flag, -(n - 1), 0)}, hot=hot)


def streak(df: DataFrame, keys, order, flag: str, out: str = "streak", *, hot=None) -> DataFrame:
    """Length of the run of flag = 1 that ends just before the current row."""
    numbered = ordered(df, keys, order, {"__n": Running("count", None, inclusive=True)}, hot=hot)
    broke = F.when(F.coalesce(F.col(flag), F.lit(0)) != 1, F.col("__n"))
    marked = ordered(numbered, keys, order, {"__reset": Running("max", broke)}, hot=hot)
    length = F.col("__n") - 1 - F.coalesce(F.col("__reset"), F.lit(0))
    return marked.withColumn(out, length).drop("__n", "__reset")
