"""Typing, renaming, code standardisation and entity lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed(expr: str | Column, dtype: str | None, default=None, *, safe: bool = False) -> Column:
    """Cast an expression, then fill NULL with `default`."""
    col = F.col(expr) if isinstance(expr, str) else expr
    if dtype is not None:
        col = col.try_cast(dtype) if safe else col.cast(dtype)
    return col if default is None else F.coalesce(col, F.lit(default).cast(dtype) if dtype else F.lit(default))


def project(df: DataFrame, spec: Mapping[str, object], *, safe: bool = False) -> DataFrame:
    """Select and type columns. Each entry is `{out: expr | (expr, type) | (expr, type, default)}`.

    `safe` turns values that cannot be cast into NULL (then `default`) instead of failing.
    """
    columns = []
    for out, entry in spec.items():
        parts = entry if isinstance(entry, tuple) else (entry, None)
        columns.append(typed(*parts, safe=safe).alias(out))
    return df.select(*columns)


def remap_expr(col: str | Column, mapping: Mapping[str, str], default: str | None = "keep") -> Column:
    """Replace codes by lookup. Unlisted codes stay (`default="keep"`) or become `default`; NULL stays."""
    value = F.col(col) if isinstance(col, str) else col
    if not mapping:
        return value
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), value)
    rest = value if default == "keep" else F.lit(default)
    return F.when(value.isNotNull(), F.coalesce(found, rest))


def remap(df: DataFrame, col: str, mapping: Mapping[str, str], default: str | None = "keep", out: str | None = None):
    return df.withColumn(out or col, remap_expr(col, mapping, default))


def standardise(df: DataFrame, col: str, rules: Sequence[tuple[str, str]], out: str | None = None) -> DataFrame:
    """Map free-text names to codes: first case-insensitive regex that matches, else upper-cased text."""
    chain = None
    for pattern, code in rules:
        hit = F.col(col).rlike(f"(?i){pattern}")
        chain = F.when(hit, F.lit(code)) if chain is None else chain.when(hit, F.lit(code))
    plain = F.upper(F.col(col))
    return df.withColumn(out or col, plain if chain is None else chain.otherwise(plain))


def ordinal(df: DataFrame, col: str, levels: Mapping[str, int], default: int = 0, out: str = "level") -> DataFrame:
    """Encode ordered levels as integers, ignoring case; NULL and unlisted become `default`."""
    pairs = [F.lit(x) for level, rank in levels.items() for x in (level.upper(), rank)]
    found = F.try_element_at(F.create_map(*pairs), F.upper(F.col(col)))
    return df.withColumn(out, F.coalesce(found, F.lit(default)))


def exclude(df: DataFrame, col: str, values: Sequence, keep_null: bool = True) -> DataFrame:
    """Drop rows whose value is listed; rows without a value stay unless `keep_null` is off."""
    stays = ~F.col(col).isin(list(values))
    return df.filter(stays | F.col(col).isNull() if keep_null else stays)


def canonical_entities(
    frames: Sequence[tuple[DataFrame, str]], mapping: Mapping[str, str] | None = None, out: str = "entity"
) -> DataFrame:
    """Distinct non-NULL codes over several sources, after remapping.

    Each source is reduced before the union, so the final shuffle only sees distinct codes.
    """
    parts = []
    for df, col in frames:
        code = remap_expr(col, mapping or {}).alias(out)
        parts.append(df.select(code).filter(F.col(out).isNotNull()).distinct())
    return reduce(DataFrame.unionByName, parts).distinct()
