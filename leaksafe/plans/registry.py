"""Named queries over the test tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` states the same result over the same tables."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            # Timestamps without zone are read as UTC throughout.
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
