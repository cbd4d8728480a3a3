"""Helpers shared by the text operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by the cluster in `spark.checkpoint.dir`.

    Only a local session that names none gets a temporary folder: no other machine reads it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
    if "at" not in _LOCAL:
        _LOCAL["at"] = tempfile.mkdtemp(prefix="leaksafe-llm-")
    return _LOCAL["at"]


def written(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: later jobs neither repeat its work nor depend on an executor."""
    path = f"{work_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once, also where `use` refers to it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def indexes(n: Column) -> Column:
    """0 .. n-1, empty for n <= 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


MATCHES = "array<struct<start:bigint,stop:bigint,hit:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with code point offsets (end exclusive).

    The pieces between the matches and the matches themselves alternate, so running
    lengths of the two give the offsets. `pattern` must not match the empty string.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def place(h: Column) -> Column:
        def offsets(p: Column) -> Column:
            sizes = F.transform(indexes(F.size(h)), lambda i: F.length(p[i]) + F.length(h[i]))
            first = F.array(F.lit(0).cast("bigint"))
            before = F.aggregate(sizes, first, lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
            return let(
                before,
                lambda b: F.transform(
                    indexes(F.size(h)),
                    lambda i: F.struct(
                        (b[i] + F.length(p[i])).alias("start"), b[i + 1].alias("stop"), h[i].alias("hit")
                    ),
                ),
            )

        return F.when(F.size(h) > 0, let(F.split(text, pattern, -1), offsets)).otherwise(F.array().cast(MATCHES))

    return let(hits, place)


def span_string(spans: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
