"""Mart assembly: star joins that keep the base grain, split labels, history filter, variants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.operators.quality import zone_of


@dataclass(frozen=True)
class Join:
    """A side to join left. `on` maps base column → side column; `cols` maps output → side column.

    The side must be unique on its key columns; `check` in `assemble` verifies that.
    """

    side: DataFrame
    on: Mapping[str, str]
    cols: Mapping[str, str]


def assemble(base: DataFrame, joins: Sequence[Join], *, check: bool = False, at: Sequence[str] = ()) -> DataFrame:
    """Left-join every side onto the base; one base row stays one row.

    Only the key and the wanted columns of a side enter the join. With `at`, columns by which the base is dealt, the wide base
    is not exchanged by other keys: sides without these columns are joined to the distinct keys first and then come to the base.
    """
    if at:
        order = [*base.columns, *[c for j in joins for c in j.cols]]
        there = [j for j in joins if not set(at) & set(j.on)]
        sides = [tuple(on) for on in dict.fromkeys(tuple(j.on) for j in there)]
        rest = [j for j in joins if set(at) & set(j.on)]
        joins = list(rest)
        for on in sides:
            asked = base.select(*at, *on).distinct()
            mine = [j for j in there if tuple(j.on) == on]
            found = assemble(asked, mine, check=check)
            joins.append(Join(found, {c: c for c in (*at, *on)}, {c: c for j in mine for c in j.cols}))
        # Longer keys first: rows sorted by them are sorted by their beginnings too.
        joins.sort(key=lambda j: list(j.on), reverse=True)
        known = F.lit(True)
        for c in at:
            known = known & F.col(c).isNotNull()
        # Without a place a base row still meets the sides that do not ask for it.
        lost = assemble(base.where(~known), there).withColumns(
            {out: F.lit(None).cast(j.side.schema[c].dataType) for j in rest for out, c in j.cols.items()}
        )
        return assemble(base.where(known), joins, check=check).select(*order).union(lost.select(*order))
    for join in joins:
        keys = {side: f"__k_{base_col}" for base_col, side in join.on.items()}
        side = join.side.select(
            *[F.col(s).alias(k) for s, k in keys.items()], *[F.col(c).alias(out) for out, c in join.cols.items()]
        )
        if check and side.groupBy(*keys.values()).count().filter("count > 1").limit(1).count():
            raise ValueError(f"side is not unique on {list(join.on.values())}")
        condition = None
        for base_col in join.on:
            same = base[base_col] == side[f"__k_{base_col}"]
            condition = same if condition is None else condition & same
        base = base.join(side, condition, "left").drop(*keys.values())
    return base


def temporal_split(period: str | Column, train_before, valid_through) -> Column:
    """'train' before a period, 'validation' through another, then 'test'."""
    period = F.col(period) if isinstance(period, str) else period
    return (
        F.when(period < train_before, F.lit("train"))
        .when(period <= valid_through, F.lit("validation"))
        .otherwise(F.lit("test"))
    )


def min_history(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """Rows whose history counts all reach n; a missing count is not enough."""
    for col in cols:
        df = df.filter(F.col(col) >= n)
    return df


def drop_zone(df: DataFrame, zone: int) -> DataFrame:
    return df.select(*[c for c in df.columns if zone_of(df, c) != zone])


def placeholder(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Add typed NULL columns `{name: type}`."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in cols.items()})
