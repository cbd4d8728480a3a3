"""Per-entity rating with period reversion, as sums and a bounded scan instead of recursion.

An entity's update depends on its own history only: with d = rating − init each row is
d ← d·(1 − revert if a new period started) + k·(outcome − expected), an affine map. Maps compose, so a whole period is one map:
within it only the row's own changes add up, and only its first row can bring a reversion. Rows therefore need one window, a
running sum per period. Periods, aggregated before any shuffle, are put into spans that begin with a reversion, and a span's
map takes d to keep·d + its sum. What a span begins with is the composition of the maps before it, evaluated from the
oldest to the newest, without powers and without division. A map more than `reach` spans back counts for less than 1e-100 and is
left out, which bounds the scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaksafe.operators.windows import HotKeys, Running, ordered


def affine_rating(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    period: str,
    outcome: str,
    home: str,
    *,
    k: float = 20.0,
    init: float = 1500.0,
    hfa: float = 65.0,
    revert: float = 0.33,
    pre: str = "rating_pre",
    post: str = "rating_post",
    seq: str = "rating_seq",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add the rating before and after each row, and the row's position.

    `outcome` is 1, 0 or NULL (no change, and then no reversion is carried into the rating
    after the row). A first row always uses the home expectation. Periods must not fall along
    `order`. `hot` is a profile of `[*keys, period]`; without it one is made. The rating after
    the row is tagged zone 3.
    """
    keep = 1.0 - revert
    expected_home = 1.0 / (1.0 + 10.0 ** (-hfa / 400.0))
    expected_away = 1.0 / (1.0 + 10.0 ** (hfa / 400.0))
    inside = [*keys, period]
    change = lambda expected: F.coalesce(k * (F.col(outcome) - expected), F.lit(0.0))
    expected = F.when(F.col(home) == 1, expected_home).otherwise(expected_away)

    place = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(F.col(outcome).isNotNull().alias("counts"), (change(expected_home) - change(expected)).alias("more"))
    periods = df.groupBy(*inside).agg(
        F.sum(change(expected)).alias("__s"), F.count(F.lit(1)).alias("__n"), F.min(place).alias("__at"), F.min_by(row, place).alias("__first")
    )
    by_period = Window.partitionBy(*keys).orderBy("__at")
    before = by_period.rowsBetween(Window.unboundedPreceding, -1)
    reverts = F.col("__first.counts") & F.col(period).isNotNull()
    periods = periods.select(
        "*", F.sum(reverts.cast("long")).over(by_period.rowsBetween(Window.unboundedPreceding, 0)).alias("__span"),
        F.sum("__n").over(before).alias("__earlier"),
    ).withColumn("__s", F.col("__s") + F.when(F.col("__earlier").isNull(), F.col("__first.more")).otherwise(0.0))

    # The composition of the spans before each span; with full reversion only the last of them counts.
    spans = periods.groupBy(*keys, "__span").agg(F.sum("__s").alias("__s"))
    by_span = Window.partitionBy(*keys).orderBy("__span")
    if 0 < keep < 1:
        reach = math.ceil(100 / -math.log10(keep))
        maps = F.collect_list("__s").over(by_span.rowsBetween(-reach, -1))
        begins = keep * F.aggregate(maps, F.lit(0.0), lambda d, s: d * keep + s)
    else:
        begins = keep * F.coalesce(F.sum("__s").over(by_span.rowsBetween(Window.unboundedPreceding if keep else -1, -1)), F.lit(0.0))
    spans = spans.select(*keys, "__span", begins.alias("__begins"))
    within = Window.partitionBy(*keys, "__span").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    periods = periods.withColumn("__sum", F.coalesce(F.sum("__s").over(within), F.lit(0.0)))
    starts = _joined(periods, spans, [*keys, "__span"]).select(
        *inside, (F.col("__begins") + F.col("__sum")).alias("__start"), "__earlier", "__first"
    )

    rows = ordered(
        df.withColumn("__delta", change(expected)), inside, order,
        {"__in": Running("sum", "__delta", inclusive=True), "__rn": Running("count", None, inclusive=True)},
        hot=hot,
    )
    out = _joined(rows, starts, inside)
    opens, first = F.col("__rn") == 1, F.col("__earlier").isNull()
    more = F.when(first, F.col("__first.more")).otherwise(0.0)
    d_post = F.col("__start") + F.col("__in") + more
    d_pre = d_post - F.col("__delta") - F.when(opens, more).otherwise(0.0)
    # A first row without outcome shows the reversion, and nothing carries it on.
    shown = opens & ~first & ~F.col("__first.counts") & F.col(period).isNotNull()
    out = out.withColumns(
        {
            pre: init + F.when(shown, keep * d_pre).otherwise(d_pre),
            post: init + d_post,
            seq: F.col("__rn") + F.coalesce("__earlier", F.lit(0)),
        }
    )
    return out.select(*df.columns, seq, pre, post).withMetadata(post, {"zone": 3})


def _joined(rows: DataFrame, side: DataFrame, on: Sequence[str]) -> DataFrame:
    """Each row with its one row of `side`; NULL meets NULL."""
    side = side.withColumnsRenamed({c: f"__j_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__j_{c}"))
    return rows.join(side, same).drop(*[f"__j_{c}" for c in on])
