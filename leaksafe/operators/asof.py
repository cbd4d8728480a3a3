"""Picks and joins in time: first, last, latest before a cutoff, nearest, bitemporal.

The joins never pair rows. Both sides are laid on one time line per key and the wanted
right-hand row is carried along it, so work is linear in the rows and a hot key is cut into
blocks (see `windows`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaksafe.functions.clocks import epoch
from leaksafe.operators.windows import HotKeys, Running, ordered, profile


def _rank(order: Sequence[str | Column], tie: Sequence[str]) -> Column:
    parts = [F.col(c) if isinstance(c, str) else c for c in [*order, *tie]]
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def _pick(df, keys, order, tie, cols, choose) -> DataFrame:
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    present = F.when(F.col(order[0]).isNotNull(), _rank(order, tie))
    best = choose(F.struct(*cols), present)
    return df.groupBy(*keys).agg(best.alias("__row")).select(*keys, "__row.*")


def first_per_key(df: DataFrame, keys, order, tie: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The earliest row per key. An aggregate, so rows are reduced before the shuffle."""
    return _pick(df, list(keys), order, tie, cols, F.min_by)


def last_per_key(df: DataFrame, keys, order, tie: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The latest row per key; rows without an order value are never picked over others."""
    return _pick(df, list(keys), order, tie, cols, F.max_by)


def _time_line(left, right, on, at, ts, tie, right_first: bool) -> DataFrame:
    l_side, r_side = (1, 0) if right_first else (0, 1)
    lefts = left.select(
        *on,
        F.col(at).cast("timestamp").alias("__t"),
        F.lit(l_side).alias("__side"),
        F.lit(None).cast(right.schema[tie].dataType).alias("__tie"),
        F.struct(*[left[c] for c in left.columns]).alias("__left"),
    )
    payload = [c for c in right.columns if c not in on]
    rights = right.filter(F.col(ts).isNotNull()).select(
        *on,
        F.col(ts).cast("timestamp").alias("__t"),
        F.lit(r_side).alias("__side"),
        F.col(tie).alias("__tie"),
        F.struct(*payload).alias("__right"),
    )
    return lefts.unionByName(rights, allowMissingColumns=True)


def _usable(on) -> Column:
    ok = F.col("__t").isNotNull()
    for key in on:
        ok = ok & F.col(key).isNotNull()
    return ok


def latest_before(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    cutoff: str,
    ts: str,
    tie: str,
    strict: bool = True,
    cols: Sequence[str] | None = None,
    *,
    prefix: str = "",
    hot: HotKeys | None = None,
) -> DataFrame:
    """For each left row the latest right row of its key with `ts` before `cutoff`.

    Strict by default; `strict=False` also allows the same instant. Left rows without a match
    stay, with NULL. Columns arrive as `prefix + name`; at one instant the largest `tie` wins.
    """
    cols = list(cols or [c for c in right.columns if c not in on])
    right = right.select(*dict.fromkeys([*on, ts, tie, *cols]))
    line = _time_line(left, right, on, cutoff, ts, tie, right_first=not strict)
    line = ordered(
        line, on, ["__t", "__side", "__tie"], {"__match": Running("last", "__right", inclusive=True)}, hot=hot
    )
    match = F.when(_usable(on), F.col("__match"))
    return line.filter(F.col("__left").isNotNull()).select(
        "__left.*", *[match.getField(c).alias(prefix + c) for c in cols]
    )


def nearest(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    at: str,
    ts: str,
    tie: str,
    cols: Sequence[str] | None = None,
    *,
    prefix: str = "",
    hot: HotKeys | None = None,
) -> DataFrame:
    """For each left row the right row of its key with the least |ts − at|; left rows are kept.

    At equal distance the earlier row wins, at one instant the largest `tie`. `tie` must be
    numeric.
    """
    cols = list(cols or [c for c in right.columns if c not in on])
    right = right.select(*dict.fromkeys([*on, ts, tie, *cols]))
    line = _time_line(left, right, on, at, ts, tie, right_first=True)
    forward, backward = ["__t", "__side", "__tie"], ["__t", "__side2", "__tie2"]
    # Cut points only balance tasks, so one profile serves both directions.
    hot = hot or profile(line, on, forward)
    line = ordered(line, on, forward, {"__back": Running("last", "__right", inclusive=True)}, hot=hot)
    line = line.withColumns({"__side2": 1 - F.col("__side"), "__tie2": -F.col("__tie")})
    line = ordered(
        line, on, backward, {"__ahead": Running("last", "__right", inclusive=True)}, descending=True, hot=hot
    )
    back, ahead = F.col("__back"), F.col("__ahead")
    behind_by = epoch("__t") - epoch(back.getField(ts))
    ahead_by = epoch(ahead.getField(ts)) - epoch("__t")
    use_back = back.isNotNull() & (ahead.isNull() | (behind_by <= ahead_by))
    match = F.when(_usable(on), F.when(use_back, back).otherwise(ahead))
    return line.filter(F.col("__left").isNotNull()).select(
        "__left.*", *[match.getField(c).alias(prefix + c) for c in cols]
    )


def latest_safe_forecast(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    cutoff: str,
    run_ts: str,
    at: str,
    target_ts: str,
    tie: str,
    cols: Sequence[str] | None = None,
    *,
    prefix: str = "",
) -> DataFrame:
    """Bitemporal pick: the latest run strictly before the cutoff, then its target nearest to `at`.

    Each distinct question (key, cutoff, instant) is answered once. Questions and runs, both distinct, share a time line per
    key, which carries the latest run to each question; questions and facts then share one per key and run, read
    in both directions. So the facts are exchanged once, by key and run, which spreads a key with many rows; rows that
    ask the same meet only in the join that brings the answers back, whose skew Spark splits. Nothing is counted
    beforehand. Ties as in `nearest`; rows without a match stay, with NULL.
    """
    cols = list(cols or [c for c in right.columns if c not in on])
    moment = lambda c: F.col(c).cast("timestamp")
    asked = [*on, "__cut", "__t"]
    left = left.select("*", moment(cutoff).alias("__cut"), moment(at).alias("__t"))
    questions = left.select(*asked).dropna().distinct()
    facts = right.select(*on, moment(run_ts).alias("__run"), moment(target_ts).alias("__t"), F.col(tie).alias("__tie"), F.struct(*cols).alias("__right"))
    facts = facts.dropna(subset=["__run", *on])

    runs = facts.select(*on, "__run").distinct().select("*", F.col("__run").alias("__x"), F.lit(1).alias("__side"))
    line = questions.select("*", F.col("__cut").alias("__x"), F.lit(0).alias("__side")).unionByName(runs, allowMissingColumns=True)
    earlier = Window.partitionBy(*on).orderBy("__x", "__side").rowsBetween(Window.unboundedPreceding, -1)
    line = line.withColumn("__latest", F.max("__run").over(earlier)).where((F.col("__side") == 0) & F.col("__latest").isNotNull())
    questions = line.select(*asked, F.col("__latest").alias("__run"), F.lit(1).alias("__side"))

    facts = facts.where(F.col("__t").isNotNull()).select("*", F.lit(0).alias("__side"), F.col("__t").alias("__at"))
    line = questions.unionByName(facts, allowMissingColumns=True)
    own = Window.partitionBy(*on, "__run")
    onward, back = own.orderBy("__t", "__side", "__tie"), own.orderBy(F.desc("__t"), "__side", "__tie")
    so_far = lambda c, order: F.last(c, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    line = line.select(
        *asked, "__side",
        so_far("__right", onward).alias("__back"), so_far("__right", back).alias("__ahead"),
        so_far("__at", onward).alias("__back_t"), so_far("__at", back).alias("__ahead_t"),
    )
    behind_by, ahead_by = epoch("__t") - epoch("__back_t"), epoch("__ahead_t") - epoch("__t")
    use_back = F.col("__back_t").isNotNull() & (F.col("__ahead_t").isNull() | (behind_by <= ahead_by))
    match = F.when(use_back, F.col("__back")).otherwise(F.col("__ahead"))
    answers = line.where(F.col("__side") == 1).select(*[F.col(c).alias(f"__q_{c}") for c in asked], match.alias("__match"))
    same = F.lit(True)
    for c in asked:
        same = same & (left[c] == answers[f"__q_{c}"])
    out = left.join(answers, same, "left")
    kept = [c for c in left.columns if c not in ("__cut", "__t")]
    return out.select(*[left[c] for c in kept], *[F.col("__match").getField(c).alias(prefix + c) for c in cols])
