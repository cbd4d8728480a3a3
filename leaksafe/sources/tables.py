"""Parquet tables: scan, canonical casts, lineage, partitioned writes, incremental planning."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CANONICAL = {"player_id": "string", "season": "int", "week": "int"}


def read_table(
    spark: SparkSession, path: str, *, schema: StructType | None = None, merge: bool = True, where: Column | str | None = None
) -> DataFrame:
    """Scan a (partitioned) Parquet directory by column name; `where` reaches partitions and row groups."""
    reader = spark.read.option("mergeSchema", merge)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df if where is None else df.filter(where)


def canonical_cast(df: DataFrame, types: Mapping[str, str] = CANONICAL) -> DataFrame:
    """Cast the listed columns that exist."""
    present = {c: F.col(c).cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def read_or_stub(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at `path`, or a typed table without rows where there is none."""
    try:
        found = spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return found.select(
        *[
            (F.col(f.name) if f.name in found.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
    )


def register(spark: SparkSession, name: str, path: str, types: Mapping[str, str] = CANONICAL) -> DataFrame:
    """Scan, cast and register one table as a temp view."""
    df = canonical_cast(read_table(spark, path), types)
    df.createOrReplaceTempView(name)
    return df


def register_all(spark: SparkSession, tables: Mapping[str, str]) -> list[str]:
    """Register every table `{view: path}` that exists; the names of those found."""
    found = []
    for name, path in tables.items():
        try:
            register(spark, name, path)
        except AnalysisException:
            continue
        found.append(name)
    return found


def row_hash(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return F.xxhash64(*(cols or df.columns))


def with_lineage(
    df: DataFrame, source: str, kind: str, version: str | None = None, *, ts: datetime | str | None = None
) -> DataFrame:
    """Add ingestion time, source name, file type, version and a hash over all original columns."""
    stamp = F.current_timestamp() if ts is None else F.lit(ts).cast("timestamp")
    return df.select(
        "*",
        stamp.alias("ingestion_ts"),
        F.lit(source).alias("source_name"),
        F.lit(kind).alias("source_file_type"),
        F.lit(version).cast("string").alias("source_version"),
        F.format_string("%016x", row_hash(df)).alias("row_hash"),
    )


def write_table(
    df: DataFrame, path: str, *, partition: Sequence[str] = (), mode: str = "overwrite", files_per_partition: int | None = None,
    replace: str = "dynamic", compression: str = "snappy",
) -> str:
    """Write Parquet. With partitions, only those present in `df` are replaced, or all with `replace="static"`.

    Rows are not pulled together by partition value, so one large partition never lands in one
    task. `files_per_partition` limits small files: rows of a partition spread over that many tasks.
    """
    writer_df = df
    if partition and files_per_partition:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        writer_df = df.repartition(*[F.col(c) for c in partition], spread)
    writer = writer_df.write.mode(mode).option("compression", compression)
    if partition:
        writer = writer.partitionBy(*partition).option("partitionOverwriteMode", replace)
    writer.parquet(path)
    return path


def buckets(spark: SparkSession) -> int:
    """Buckets of a dealt table: as many as a shuffle has partitions, so either side of a join can keep its place."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_dealt(df: DataFrame, path: str, by: Sequence[str], *, compression: str = "snappy") -> DataFrame:
    """Write in buckets by some columns and read it back, known to be dealt by them.

    No exchange is added: a task writes one file for each bucket it has rows of, so rows should come dealt by the same columns.
    The table is registered under a name of its own; the files are the caller's.
    """
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").format("parquet").option("path", path).option("compression", compression)
    writer.bucketBy(buckets(spark), *by).saveAsTable(name)
    return spark.table(name).select(*df.columns)


def content_digest(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per partition the number of rows and two sums over their hashes: equal whatever the order of rows or files.

    Repeated rows count (the plain sum tells them apart, where exclusive-or alone would cancel pairs). Parts
    add up, so rows are reduced before the shuffle.
    """
    columns = [c for c in sorted(df.columns) if c not in by]
    hashed = df.select(*by, F.xxhash64(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{c}`").isNull() for c in columns]).alias("__h"))
    return hashed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("__h").cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor("__h").alias("hash_xor")
    )


def refresh_changed(df: DataFrame, path: str, by: Sequence[str]) -> DataFrame:
    """Reload a partitioned table, writing anew only partitions whose rows differ from what is there.

    Returns a row per partition: `status` is new, rewritten, unchanged, or kept (in the table, not in `df`, left as it is).
    What the table holds is told by digests beside it (`path`.digests), or from its rows where there are none.
    Data are written before digests: a run that fails in between writes the same partitions again. The newest two versions
    of the digests stay.
    """
    spark, beside = df.sparkSession, f"{path}.digests"
    came = content_digest(df, by)
    versions = existing_partitions(spark, beside, "version")
    if versions:
        held = spark.read.schema(came.schema).parquet(f"{beside}/version={versions[-1]}")
    else:
        held = content_digest(read_or_stub(spark, path, df.schema), by)
    held = held.withColumnsRenamed({c: f"__held_{c}" for c in held.columns})
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__held_{c}"))
    both = came.withColumn("__came", F.lit(True)).join(held, same, "full_outer")
    equal = F.lit(True)
    for c in ("rows", "hash_sum", "hash_xor"):
        equal = equal & F.col(c).eqNullSafe(F.col(f"__held_{c}"))
    status = F.when(F.col("__came").isNull(), "kept").when(F.col("__held_rows").isNull(), "new").when(equal, "unchanged").otherwise("rewritten")
    either = [F.when(F.col("__came").isNull(), F.col(f"__held_{c}")).otherwise(F.col(c)).alias(c) for c in came.columns]
    # One row per partition: read back, because the tables it comes from change now.
    version = f"{beside}/version={versions[-1] + 1 if versions else 0}"
    both.select(*either, status.alias("status")).write.mode("overwrite").parquet(f"{beside}/planned")
    planned = spark.read.parquet(f"{beside}/planned")
    todo = planned.filter(F.col("status").isin("new", "rewritten")).select(*[F.col(c).alias(f"__todo_{c}") for c in by])
    wanted = F.lit(True)
    for c in by:
        wanted = wanted & F.col(c).eqNullSafe(F.col(f"__todo_{c}"))
    write_table(df.join(todo, wanted, "left_semi"), path, partition=by)
    planned.drop("status").write.mode("overwrite").parquet(version)
    return planned.select(*by, "status", "rows")


def write_report(df: DataFrame, path: str, kind: str = "csv") -> str:
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
    return path


def existing_partitions(spark: SparkSession, path: str, column: str) -> list[int]:
    """Partition values of a table, from its directory names (`column=value`), without reading data."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder) if status.isDirectory()]
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=") and n.split("=", 1)[1].isdigit())


def partitions_to_refresh(existing: Iterable[int], wanted: Iterable[int], always: Iterable[int], force: bool = False) -> list[int]:
    """Everything when forced; else the wanted partitions that are missing, and those always refreshed."""
    wanted = list(wanted)
    if force:
        return wanted
    have = set(existing)
    return list(dict.fromkeys([w for w in wanted if w not in have] + list(always)))


def path_part(name: str, type_: str = "string", path: Column | None = None) -> Column:
    """The value of `name=value` in a row's file path (or any path), NULL where it has none."""
    found = F.regexp_extract(F.input_file_name() if path is None else path, f"(?:^|/){name}=([^/]+)", 1)
    return F.when(found != "", found).try_cast(type_)


def expand_range(spark: SparkSession, start: int, end: int, name: str = "season") -> DataFrame:
    """All integers of an inclusive range, as a column."""
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias(name))


def resolve_periods(spec: str | int | Sequence[int], current: int) -> list[int]:
    """'2015:current', '2015:2020', a number or a list → the periods."""
    if isinstance(spec, str):
        start, end = (current if part.strip() == "current" else int(part) for part in spec.split(":"))
        return list(range(start, end + 1))
    return [spec] if isinstance(spec, int) else list(spec)


def pending_keys(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys that are not loaded yet."""
    return df.select(*keys).distinct().join(existing.select(*keys), list(keys), "left_anti")
