"""Event rollups: one partial aggregation for any mix of conditional measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


@dataclass(frozen=True)
class Agg:
    """One measure. Kinds:

    count       rows that satisfy `where`
    distinct    distinct values of `col`
    sum, avg, min, max, stddev_pop   of `col` over rows that satisfy `where`
    rate        share of rows (that satisfy `where`) where the condition `col` holds
    ratio       sum(col) / sum(den) where `den` is positive, else NULL
    """

    kind: str
    col: object = None
    where: Column | None = None
    den: object = None

    def column(self) -> Column:
        kind, where = self.kind, self.where
        if kind == "count":
            return F.count(F.lit(1)) if where is None else F.count_if(where)
        if kind == "ratio":
            num, den = _c(self.col), _c(self.den)
            if where is not None:
                num, den = F.when(where, num), F.when(where, den)
            return F.when(F.sum(den) > 0, F.sum(num).cast("double") / F.sum(den))
        value = _c(self.col)
        if kind == "rate":
            value = F.when(value, F.lit(1.0)).otherwise(F.lit(0.0))
        if where is not None:
            value = F.when(where, value)
        return {
            "distinct": F.count_distinct,
            "sum": F.sum,
            "avg": F.avg,
            "rate": F.avg,
            "min": F.min,
            "max": F.max,
            "stddev_pop": F.stddev_pop,
        }[kind](value)


def rollup(df: DataFrame, keys: Sequence[str], spec: Mapping[str, Agg]) -> DataFrame:
    """Aggregate events per key; rows are combined before the shuffle, so a hot key is harmless."""
    return df.groupBy(*keys).agg(*[agg.column().alias(out) for out, agg in spec.items()])


def two_sided_rollup(
    df: DataFrame,
    keys: Sequence[str],
    own: str,
    other: str,
    spec_own: Mapping[str, Agg],
    spec_other: Mapping[str, Agg],
    *,
    entity: str = "entity",
) -> DataFrame:
    """Roll the same events up by the two sides that took part in them.

    Every side that appears in either role gets a row; a role it never had is NULL. Each role is
    aggregated from one read of the events, and the two results, which share no measure, are put
    side by side by a last aggregation over the sides.
    """
    mine = rollup(df.filter(F.col(own).isNotNull()).withColumn(entity, F.col(own)), [*keys, entity], spec_own)
    theirs = rollup(df.filter(F.col(other).isNotNull()).withColumn(entity, F.col(other)), [*keys, entity], spec_other)
    both = mine.unionByName(theirs, allowMissingColumns=True)
    measures = [*spec_own, *spec_other]
    # At most one row of a side holds a measure.
    return both.groupBy(*keys, entity).agg(*[F.first(c, ignorenulls=True).alias(c) for c in measures])
