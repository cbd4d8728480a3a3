"""Keyed tables: last write per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Union of both, one row per key: incoming wins, and within a side the largest `order`.

    An aggregate with map-side combine, so repeated writes of one key are reduced early.
    """
    rest = [c for c in existing.columns if c not in keys]
    both = existing.withColumn("__new", F.lit(0)).unionByName(incoming.withColumn("__new", F.lit(1)))
    rank = F.struct(F.col("__new").alias("o"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    return (
        both.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), rank).alias("__row"))
        .select(*keys, "__row.*")
        .select(*existing.columns)
    )
