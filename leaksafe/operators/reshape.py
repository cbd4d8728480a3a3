"""Side unpivots, row pairing, wide/long forms and measure pivots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaksafe.operators.windows import HotKeys, Running, ordered


def _c(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def two_sides(
    df: DataFrame, left: Mapping[str, object], right: Mapping[str, object], flag: str = "home_flag", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per side from one scan: `flag` is 1 for `left` and 0 for `right`.

    Both mappings are `{out: column}` with the same outputs; `keep` columns are repeated.
    """
    if set(left) != set(right):
        raise ValueError("both sides need the same output columns")
    sides = [
        F.struct(*[_c(spec[name]).alias(name) for name in left], F.lit(value).alias(flag))
        for spec, value in ((left, 1), (right, 0))
    ]
    return df.select(*keep, F.explode(F.array(*sides)).alias("__side")).select(*keep, "__side.*")


def wide_to_long(df: DataFrame, ids: Sequence[str], variants: Sequence[Mapping[str, object]]) -> DataFrame:
    """One output row per variant and input row, from one scan; variants share their output columns."""
    names = list(variants[0])
    rows = [F.struct(*[_c(v[name]).alias(name) for name in names]) for v in variants]
    return df.select(*ids, F.explode(F.array(*rows)).alias("__v")).select(*ids, "__v.*")


def pair_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    roles: tuple[str, str] = ("first", "second"),
    *,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Pair consecutive rows: odd rows take the first role, even rows the second.

    Returns `pair_no`, `{role}_{value}` columns and `complete` (0 for an unpaired last row).
    """
    numbered = ordered(df, keys, order, {"__n": Running("count", None, inclusive=True)}, hot=hot)
    odd = F.col("__n") % 2 == 1
    picks = []
    for role, here in zip(roles, (odd, ~odd)):
        picks += [F.max(F.when(here, F.col(v))).alias(f"{role}_{v}") for v in values]
    return (
        numbered.withColumn("pair_no", F.floor((F.col("__n") + 1) / 2))
        .groupBy(*keys, "pair_no")
        .agg(*picks, (F.count(F.lit(1)) == 2).cast("int").alias("complete"))
    )


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    pivot: str,
    values: Sequence[str],
    measures: Mapping[str, Callable[[Column], Column]],
    fill=0,
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Aggregate per key and pivot value, one column `{value}_{measure}` each; gaps become `fill`.

    A measure takes the condition "the row has this value" and returns an aggregate. `extra`
    aggregates run over all rows of the key. The values are given, so no job looks them up.
    """
    picked = [c.alias(n) for n, c in (extra or {}).items()]
    for value in values:
        for name, build in measures.items():
            picked.append(build(F.col(pivot) == value).alias(f"{value}_{name}"))
    out = df.groupBy(*keys).agg(*picked)
    if fill is None:
        return out
    return out.fillna(fill, subset=[f"{v}_{m}" for v in values for m in measures])
