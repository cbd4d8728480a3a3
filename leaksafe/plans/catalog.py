"""Relations by name: a function of other relations, run in dependency order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaksafe.sources.tables import write_table


#: Tasks that a partition's rows are spread over when a relation is written, so files per partition at most.
FILES_PER_PARTITION = 16


@dataclass(frozen=True)
class Relation:
    """`build` takes the frames of `needs` in order. Shared, costly relations set `materialise`.

    With `stay`, wide rows dealt by some of a join's keys stay where they are and the narrow side comes to them. Only for
    relations whose rows are dealt by keys with many values, and only while they are written. `deal` names the columns by
    which a shared relation is written in buckets; its builder leaves the rows dealt by them, or most of them.
    """

    name: str
    needs: tuple[str, ...]
    build: Callable[..., DataFrame]
    materialise: bool = False
    partition: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    stay: bool = False
    deal: tuple[str, ...] = ()


class Catalog:
    def __init__(self, relations: Iterable[Relation] = ()):
        self.relations = {r.name: r for r in relations}

    def relation(self, *needs: str, name: str | None = None, **settings):
        """Decorator that adds a builder under its function's name."""

        def add(build):
            relation = Relation(name or build.__name__, needs, build, **settings)
            self.relations[relation.name] = relation
            return build

        return add

    def order(self, targets: Sequence[str] | None = None) -> list[str]:
        """Targets and everything they need, dependencies first."""
        wanted, stack = set(), list(targets or self.relations)
        while stack:
            name = stack.pop()
            if name not in wanted:
                wanted.add(name)
                stack += self.relations[name].needs if name in self.relations else ()
        graph = {n: self.relations[n].needs if n in self.relations else () for n in sorted(wanted)}
        return [n for n in TopologicalSorter(graph).static_order()]


def build(catalog: Catalog, sources: Mapping[str, DataFrame], targets: Sequence[str]) -> dict[str, DataFrame]:
    """The targets (and what they need) as lazy frames; nothing is run or written."""
    frames = dict(sources)
    for name in catalog.order(targets):
        if name not in frames:
            relation = catalog.relations[name]
            frames[name] = relation.build(*[frames[n] for n in relation.needs])
    return frames


def materialise(
    spark: SparkSession, relation: Relation, df: DataFrame, root: str, *, period: tuple[str, int] | None = None
) -> DataFrame:
    """Write a relation and read it back, which cuts its lineage. An empty relation reads back as no rows.

    With `period` only that partition of a partitioned relation is rebuilt, and stays as it is if
    there is nothing for it; without, the whole table is replaced, partitions that are gone included.
    """
    path = f"{root}/{relation.name}"
    one = bool(period and period[0] in df.columns and period[0] in relation.partition)
    if one:
        df = df.filter(F.col(period[0]) == period[1])
    write_table(df, path, partition=relation.partition, files_per_partition=FILES_PER_PARTITION, replace="dynamic" if one else "static")
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def run(
    spark: SparkSession,
    catalog: Catalog,
    sources: Mapping[str, DataFrame],
    root: str,
    *,
    targets: Sequence[str] | None = None,
    period: tuple[str, int] | None = None,
    write_all: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run relations in dependency order and register them as views.

    A failure stops the relations that depend on it, not the others. Returns the frames and a
    table (name, status, detail). Only relations marked `materialise` (or all, with
    `write_all`) are written; the rest stay lazy, so Catalyst sees across them.
    """
    frames, status = dict(sources), []
    for name in catalog.order(targets):
        if name in frames:
            continue
        relation = catalog.relations.get(name)
        if relation is None:
            status.append((name, "MISSING", "no source"))
            continue
        blocked = [n for n in relation.needs if n not in frames]
        if blocked:
            status.append((name, "SKIPPED", "needs " + ", ".join(blocked)))
            continue
        try:
            df = relation.build(*[frames[n] for n in relation.needs])
            if relation.materialise or write_all:
                df = materialise(spark, relation, df, root, period=period)
            df.createOrReplaceTempView(name)
        except (PySparkException, ValueError) as error:
            status.append((name, "ERROR", str(error).splitlines()[0]))
            continue
        frames[name] = df
        status.append((name, "OK", ""))
    return frames, spark.createDataFrame(status or [("-", "OK", "nothing to do")], "name string, status string, detail string")
