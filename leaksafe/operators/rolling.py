"""Lagged rolling form. Frames end at the row before the current one; that is not a parameter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.features import _c
from leaksafe.operators.windows import Frame, HotKeys, Running, ordered


def lagged(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str] | Mapping[str, Sequence[str]],
    windows: Mapping[str, int | None],
    *,
    aggs: Sequence[str] = ("avg",),
    count: str | None = "games_played",
    names: Mapping[tuple[str, str], str] | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add aggregates over earlier rows of the key.

    `windows` maps a suffix to the number of earlier rows (None: all of them). Outputs are
    `{col}_{suffix}`, with `_{agg}` appended for any aggregate but avg. `cols` may map a
    suffix to its own columns, and `names` renames single outputs by (col, suffix). `count`
    names the number of earlier rows: 0 on a key's first row, where the averages are NULL.
    """
    outputs = {}
    for suffix, n in windows.items():
        for col in cols[suffix] if isinstance(cols, Mapping) else cols:
            for agg in aggs:
                name = (names or {}).get((col, suffix)) or f"{col}_{suffix}" + ("" if agg == "avg" else f"_{agg}")
                value = F.col(col).cast("double") if agg == "avg" else col
                outputs[name] = Running(agg, value) if n is None else Frame(agg, value, -n, -1)
    if count:
        outputs[count] = Running("count")
    return ordered(df, keys, order, outputs, hot=hot)


def sequence(df: DataFrame, keys, order, out: str = "seq", *, hot: HotKeys | None = None) -> DataFrame:
    """1-based position of each row within its key."""
    return ordered(df, keys, order, {out: Running("count", None, inclusive=True)}, hot=hot)


def prior_period_avg(df: DataFrame, keys: Sequence[str], period: str, cols: Mapping[str, str]) -> DataFrame:
    """Full-period averages `{out: col}`, filed under the period they may be used in (the next one)."""
    means = [F.avg(F.col(c).cast("double")).alias(out) for out, c in cols.items()]
    return df.groupBy(*keys, period).agg(*means).withColumn(period, F.col(period) + 1)


def blend_prior(cur, prior, n, w: float = 0.7, min_n: int = 3) -> Column:
    """Shrink current form toward the prior period: w·cur + (1 − w)·prior once n ≥ min_n, else prior.

    A missing part counts as 0.
    """
    zero = F.lit(0.0)
    cur, prior = F.coalesce(_c(cur), zero), F.coalesce(_c(prior), zero)
    return F.when(_c(n) >= min_n, w * cur + round(1 - w, 12) * prior).otherwise(prior)
