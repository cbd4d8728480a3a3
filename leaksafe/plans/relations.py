"""All relations in one catalog, and their frames over the derived raw tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from leaksafe.plans.catalog import Catalog
from leaksafe.plans.derived import DEALT, SHARED, TABLES, is_raw, raw_frame
from leaksafe.plans.dimensions import DIMENSIONS
from leaksafe.plans.intermediate import INTERMEDIATE
from leaksafe.plans.marts import MARTS
from leaksafe.plans.registry import table
from leaksafe.plans.staging import STAGING
from leaksafe.sources.tables import write_dealt, write_table

CATALOG = Catalog(
    [
        *STAGING.relations.values(),
        *INTERMEDIATE.relations.values(),
        *MARTS.relations.values(),
        *DIMENSIONS.relations.values(),
    ]
)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint directory; a local session without one uses a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
        root = tempfile.gettempdir()
    return f"{root}/leaksafe-{name}-{uuid.uuid4().hex}"


ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


@contextmanager
def staying(spark: SparkSession, stay: bool) -> Iterator[None]:
    """While it lasts, a join may leave rows dealt by a part of its keys in place."""
    before = spark.conf.get(ALL_KEYS)
    if stay:
        spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)


#: Rows of the test tables for each partition of a shuffle.
ROWS_PER_TASK = 200_000
PARTITIONS = "spark.sql.shuffle.partitions"


def partitions_for(spark: SparkSession, folder: str) -> int:
    """Shuffle partitions that keep a task's rows the same as the tables grow. Rows are counted from file footers."""
    rows = 0
    for name in TABLES:
        try:
            rows += table(spark, folder, name).count()
        except AnalysisException:  # a table that is not there has no rows
            continue
    return -(-rows // ROWS_PER_TASK)


class Relations:
    """Frames of relations over one folder of test tables, built on demand.

    Relations marked `materialise` are written once per session and shared by everything that
    needs them; the others stay lazy. They are read whole and only by this session, so each task writes the rows it
    has: no exchange brings those of a period together, as it does for tables that are refreshed by period. Those with
    `deal` are written in buckets by these columns, so what groups or joins by them exchanges their rows no more.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.root = scratch(spark, "relations")
        self.partitions = partitions_for(spark, folder)
        self.frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.frames:
            if is_raw(name):
                df = raw_frame(self.spark, self.folder, name, self.__getitem__)
                shared, stay, deal = name in SHARED, False, DEALT.get(name, ())
            else:
                relation = CATALOG.relations[name]
                df = relation.build(*[self[n] for n in relation.needs])
                shared, stay, deal = relation.materialise, relation.stay, relation.deal
            if shared:
                with staying(self.spark, stay):
                    path = f"{self.root}/{name}"
                    if deal:
                        df = write_dealt(df, path, deal, compression="zstd")
                    else:
                        write_table(df, path, compression="zstd")
                        df = self.spark.read.schema(df.schema).parquet(path)
            self.frames[name] = df
        return self.frames[name]


_OPEN: dict[tuple[str, str], Relations] = {}


def relations(spark: SparkSession, folder: str) -> Relations:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _OPEN:
        _OPEN[key] = Relations(spark, folder)
    # Later shuffles and buckets have as many partitions as the tables ask for, or more if the session is set to more.
    if int(spark.conf.get(PARTITIONS)) < _OPEN[key].partitions:
        spark.conf.set(PARTITIONS, _OPEN[key].partitions)
    return _OPEN[key]
