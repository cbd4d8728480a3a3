"""Prediction horizons: bucket snapshots by hours before an event, pivot, expand, attach."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.functions.clocks import hours_between

# Lower edge in hours (the first also excludes its edge) and label, latest last.
BUCKETS = (("open", 120.0), ("72h", 72.0), ("24h", 24.0), ("6h", 6.0), ("1h", 1.0), ("close", 0.0))
HORIZONS = (("early_week", 120), ("mid_week", 72), ("pre_kickoff", 1))
# Which bucket a model at each horizon may read.
HORIZON_BUCKETS = {"early_week": "open", "mid_week": "72h", "pre_kickoff": "1h"}


def bucket_expr(hours: Column, buckets: Sequence[tuple[str, float]] = BUCKETS) -> Column:
    """Label hours before the event: above the first edge, then each [edge, previous edge)."""
    (top, edge), *rest = buckets
    chain = F.when(hours > edge, F.lit(top))
    for label, low in rest:
        chain = chain.when(hours >= low, F.lit(label))
    return chain


def bucket_latest(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    event_ts: str,
    tie: Sequence[str],
    *,
    buckets: Sequence[tuple[str, float]] = BUCKETS,
    cols: Sequence[str] | None = None,
    out: str = "time_bucket",
) -> DataFrame:
    """The latest row per key in each bucket. Rows after the event are dropped.

    The bucket is computed once and the pick is an aggregate, so a key with very many
    snapshots is reduced before the shuffle.
    """
    cols = list(cols or [c for c in df.columns if c not in keys])
    hours = hours_between(event_ts, ts)
    placed = df.withColumn("hours_before", hours).filter(F.col("hours_before") >= 0)
    placed = placed.withColumn(out, bucket_expr(F.col("hours_before"), buckets))
    rank = F.struct(F.col(ts).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)])
    row = F.max_by(F.struct(*cols, "hours_before"), rank).alias("__row")
    return placed.groupBy(*keys, out).agg(row).select(*keys, out, "__row.*")


def pivot(
    df: DataFrame, keys: Sequence[str], value: str, labels: Sequence[str], *, bucket: str = "time_bucket", prefix: str = "line_"
) -> DataFrame:
    """One column per bucket label."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(bucket) == label, F.col(value))).alias(f"{prefix}{label}") for label in labels]
    )


def expand(df: DataFrame, horizons: Sequence[tuple[str, int]] = HORIZONS) -> DataFrame:
    """One row per input row and horizon, without a join."""
    rows = [F.struct(F.lit(n).alias("prediction_horizon"), F.lit(h).alias("hours_before_event")) for n, h in horizons]
    return df.withColumn("__h", F.explode(F.array(*rows))).select(*df.columns, "__h.*")


def attach(
    df: DataFrame,
    bucketed: DataFrame,
    keys: Sequence[str],
    mapping: Mapping[str, str] = HORIZON_BUCKETS,
    *,
    value: str,
    out: str | None = None,
    bucket: str = "time_bucket",
    horizon: str = "prediction_horizon",
) -> DataFrame:
    """Give each (key, horizon) row the value of the bucket it may read, and an availability flag."""
    out = out or value
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    wanted = F.try_element_at(F.create_map(*pairs), F.col(horizon))
    side = bucketed.select(*keys, F.col(bucket).alias("__bucket"), F.col(value).alias(out))
    joined = df.withColumn("__bucket", wanted).join(side, [*keys, "__bucket"], "left").drop("__bucket")
    return joined.withColumn(f"{out}_available", F.col(out).isNotNull().cast("int"))
