"""Snapshot feeds as Structured Streaming jobs.

Event times without zone are cast when the stream is read: a watermark needs an instant.

State is bounded by when rows *arrive*, not by when they happened. Arrival never runs backwards (by default it is the time of
the micro-batch, which a retry repeats), so a watermark on it drops no row, however late its event; the tables keep what the
state gives up. A table's folders tell which part of it a batch can touch, and nothing else is read or rewritten.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

DELTAS = 64  # small files a bucket of `latest_per_key` may have before they are merged
GROWTH = 2  # a bucket is merged when its deltas hold as much as its base divided by this
BUCKET_BYTES = 256 << 20
FIRST_BITS = 3
_ARRIVED = "__arrived"


def read_snapshots(
    spark: SparkSession, path: str, schema: StructType | str, ts: str, *, files_per_trigger: int | None = None, pattern: str | None = None
) -> DataFrame:
    """A folder of Parquet snapshots (files matching `pattern`) as a stream with `ts` as an instant."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


# --- folders ---------------------------------------------------------------------------------


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes by `a=1/b=2` of the innermost partition folders of a table, from names and lengths of its files alone."""
    root, fs = _path(spark, path)
    out: dict[str, int] = {}
    if fs.exists(root):
        base = fs.getFileStatus(root).getPath().toString() + "/"
        files = fs.listFiles(root, True)
        while files.hasNext():
            file = files.next()
            name = file.getPath().toString()[len(base) :]
            if not any(part.startswith(("_", ".")) and "=" not in part for part in name.split("/")):
                inside = name.rpartition("/")[0]
                out[inside] = out.get(inside, 0) + file.getLen()
    return out


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    for folder in paths:
        path, fs = _path(spark, folder)
        fs.delete(path, True)


def _values(folder: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in folder.split("/"))


def _load(spark: SparkSession, schema: StructType, path: str, names: Sequence[str]) -> DataFrame:
    """The rows of some folders of a table, without the columns its folders stand for."""
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names])


def _replace(df: DataFrame, path: str, *by: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _run(writer, checkpoint: str) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _arrival(arrived: str | None) -> Column:
    return F.current_timestamp() if arrived is None else F.col(arrived).cast("timestamp")


# --- every snapshot once ---------------------------------------------------------------------


def append_new(
    stream: DataFrame, keys: Sequence[str], ts: str, path: str, checkpoint: str, *, delay: str = "7 days", arrived: str | None = None
) -> StreamingQuery:
    """Append the snapshots that the table does not hold yet, however late and in whatever batches they come.

    The grain is `keys` and the snapshot time. Repeats that arrive within `delay` of each other meet in the state, which
    forgets a grain after that. A snapshot at most `delay` old cannot have arrived before, so it is appended unseen; an older
    one is compared with what the table holds of its own day, and of no other. Each batch writes parts of its own, which a
    retry writes anew. `arrived` names a column of arrival times that never fall behind by more than `delay`. Read with
    `read_appended`.
    """
    grain = list(dict.fromkeys([*keys, ts]))
    once = stream.withColumn(_ARRIVED, _arrival(arrived)).withWatermark(_ARRIVED, delay).dropDuplicatesWithinWatermark(grain)
    fields = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        spark, table, own = batch.sparkSession, f"{path}/rows", f"{number:010d}"
        staged = f"{path}/staged"
        rows = batch.withColumn("__late", ~F.coalesce(F.col(ts) >= F.col(_ARRIVED) - F.expr(f"INTERVAL {delay}"), F.lit(False)))
        rows = rows.drop(_ARRIVED).withColumns({"__day": F.coalesce(F.to_date(ts).cast("string"), F.lit("none")), "__part": F.lit(own)})
        _replace(rows, staged, "__part", "__late", "__day")
        names = [n for n in folders(spark, staged) if _values(n)["__part"] == own]
        days = {late: sorted({_values(n)["__day"] for n in names if _values(n)["__late"] == late}) for late in ("true", "false")}
        fresh = [_load(spark, fields, staged, [f"__part={own}/__late=false/__day={d}" for d in days["false"]])]
        if days["true"]:
            came = _load(spark, fields, staged, [f"__part={own}/__late=true/__day={d}" for d in days["true"]])
            # Rows of this batch differ in their grain, so earlier parts are all there is to compare with.
            fresh.append(_without(came, held_rows(spark, fields, table, days["true"], before=own), grain))
        out = reduce(DataFrame.unionByName, fresh)
        _replace(out.withColumns({"__day": F.coalesce(F.to_date(ts).cast("string"), F.lit("none")), "__part": F.lit(own)}), table, "__day", "__part")
        remove(spark, [staged])

    return _run(once.writeStream.foreachBatch(write), checkpoint)


def held_rows(spark: SparkSession, schema: StructType, table: str, days: Sequence[str], before: str) -> DataFrame:
    """What earlier parts hold of some days: only those days' folders are listed and read."""
    names = [f"__day={d}/{n}" for d in days for n in folders(spark, f"{table}/__day={d}") if _values(n)["__part"] < before]
    return _load(spark, schema, table, names)


def _without(rows: DataFrame, held: DataFrame, grain: Sequence[str]) -> DataFrame:
    held = held.select(*[F.col(f"`{c}`").alias(f"__h_{c}") for c in grain])
    same = reduce(Column.__and__, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__h_{c}`")) for c in grain])
    return rows.join(held, same, "left_anti")


def read_appended(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table written by `append_new`."""
    root, fs = _path(spark, f"{path}/rows")
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)


# --- consensus per window --------------------------------------------------------------------


def consensus_parts(
    stream: DataFrame, keys: Sequence[str], ts: str, window: str, book: str, value: str, prob: str | None = None,
    *, delay: str = "1 day", arrived: str | None = None,
) -> DataFrame:
    """Mergeable partial consensus per tumbling window and stretch of arrival.

    A stretch of arrival lasts `delay` and closes `delay` after its end; its state goes then. Rows that come later for the
    same window make a part of their own. Books are kept as an exact set of codes, which is small by nature.
    """
    rows = stream.where(F.col(ts).isNotNull()).withColumn(_ARRIVED, _arrival(arrived)).withWatermark(_ARRIVED, delay)
    # The window of the event becomes a plain column first: a grouping takes one window.
    rows = rows.withColumn("__w", F.window(ts, window))
    known = F.col(value).isNotNull()
    grouped = rows.groupBy(F.window(_ARRIVED, delay).alias("__a"), "__w", *keys).agg(
        F.collect_set(book).alias("books"), F.count(value).alias("n"), F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(F.when(known, 1))).alias("spread"), F.min(value).alias("low"), F.max(value).alias("high"),
        *([F.sum(prob).alias("prob_sum"), F.count(prob).alias("prob_n")] if prob else []),
    )
    return grouped.select(
        F.unix_seconds("__a.start").alias("__arrival"), F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
        *keys, "books", "n", "mean", "spread", "low", "high", *(["prob_sum", "prob_n"] if prob else []),
    )


def merge_parts(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One part per window out of several. Squared deviations are put together pair by pair, not as differences of squares."""
    empty = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("spread"))

    def join(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        some = F.when(b["n"] > 0, b["n"] / n)
        return F.struct(
            n.alias("n"),
            F.coalesce(a["mean"] + apart * some, a["mean"]).alias("mean"),
            F.coalesce(a["spread"] + b["spread"] + apart * apart * a["n"] * some, a["spread"]).alias("spread"),
        )

    probs = [c for c in ("prob_sum", "prob_n") if c in parts.columns]
    merged = parts.groupBy("window_start", "window_end", *keys).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("books")))).alias("books"),
        F.aggregate(F.collect_list(F.struct("n", "mean", "spread")), empty, join).alias("__m"),
        F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(c).alias(c) for c in probs],
    )
    of = lambda c: F.when(F.col("__m.n") > 0, F.col(f"__m.{c}"))
    return merged.select(
        "window_start", "window_end", *keys, "books", F.col("__m.n").alias("n"), of("mean").alias("mean"), of("spread").alias("spread"),
        "low", "high", *probs,
    )


def latest_rows(batch: DataFrame, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in batch.columns if c not in keys]
    rank = F.struct(F.col(ts).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)])
    return batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__r")).select(*keys, "__r.*")


def consensus_table(parts: DataFrame, keys: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Keep the parts of `consensus_parts`; `read_consensus` shows every window as it is now, also the open ones.

    A batch writes the parts it changed under their stretch of arrival. A stretch that a later one follows is closed: its parts
    are folded into a table by day of the window, where only the days it touched are read and written anew, as versions
    named after the stretch. A marker says how far folding is done; what is beyond it is read from the stretches, so a
    batch that fails halfway and runs again counts no row twice. Of each day the last two versions stay.
    """
    schema = parts.drop("__arrival").schema

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        _replace(batch.withColumn("__batch", F.lit(f"{number:010d}")), f"{path}/open", "__arrival", "__batch")
        stretches = sorted({int(_values(n)["__arrival"]) for n in folders(spark, f"{path}/open")})
        for stretch in stretches[:-2]:  # the one before the last may still change within the delay
            if stretch > folded(spark, path):
                _fold(spark, schema, keys, path, stretch)
            remove(spark, [f"{path}/open/__arrival={stretch}"])

    return _run(parts.writeStream.outputMode("update").foreachBatch(write), checkpoint)


def folded(spark: SparkSession, path: str) -> int:
    """The last stretch of arrival that the table by day holds."""
    done = [int(_values(n)["__arrival"]) for n in folders(spark, f"{path}/folded")]
    return max(done, default=-(1 << 62))


def _open_parts(spark: SparkSession, schema: StructType, keys: Sequence[str], path: str, stretches: Callable[[int], bool]) -> DataFrame:
    """The last state of each part of some stretches."""
    fields = StructType.fromDDL("__arrival bigint, __batch string")
    names = [n for n in folders(spark, f"{path}/open") if stretches(int(_values(n)["__arrival"]))]
    if not names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(StructType([*schema.fields, *fields.fields])).option("basePath", f"{path}/open")
    rows = reader.parquet(*[f"{path}/open/{n}" for n in names])
    return latest_rows(rows, ["window_start", "window_end", *keys, "__arrival"], "__batch").select(*schema.names)


def _versions(spark: SparkSession, path: str, upto: int, days: Iterable[str] | None = None) -> dict[str, list[int]]:
    """Versions up to a stretch, of some days or of all."""
    out: dict[str, list[int]] = {}
    places = folders(spark, f"{path}/closed") if days is None else (f"__day={d}/{n}" for d in days for n in folders(spark, f"{path}/closed/__day={d}"))
    for name in places:
        place = _values(name)
        if int(place["__version"]) <= upto:
            out.setdefault(place["__day"], []).append(int(place["__version"]))
    return {day: sorted(versions) for day, versions in out.items()}


def _fold(spark: SparkSession, schema: StructType, keys: Sequence[str], path: str, stretch: int) -> None:
    before = folded(spark, path)
    day = F.to_date("window_start").cast("string")
    came = _open_parts(spark, schema, keys, path, lambda s: s == stretch)
    days = sorted(r[0] for r in came.select(day).distinct().collect())  # the days of one stretch
    held = _versions(spark, path, before, days)
    rows = came.unionByName(_load(spark, schema, f"{path}/closed", [f"__day={d}/__version={v[-1]}" for d, v in held.items()]))
    out = merge_parts(rows, keys).withColumns({"__day": day, "__version": F.lit(stretch)})
    _replace(out, f"{path}/closed", "__day", "__version")
    spark.range(1).write.mode("overwrite").parquet(f"{path}/folded/__arrival={stretch}")
    remove(spark, [f"{path}/closed/__day={d}/__version={v}" for d, versions in held.items() for v in versions[:-1]])
    remove(spark, [f"{path}/folded/{n}" for n in folders(spark, f"{path}/folded") if int(_values(n)["__arrival"]) < stretch])


def read_consensus(spark: SparkSession, parts: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Every window written by `consensus_table`, with the consensus columns; `parts` gives the schema."""
    schema, done = parts.drop("__arrival").schema, folded(spark, path)
    closed = [f"__day={d}/__version={v[-1]}" for d, v in _versions(spark, path, done).items()]
    rows = _load(spark, schema, f"{path}/closed", closed).unionByName(_open_parts(spark, schema, keys, path, lambda s: s > done))
    whole = merge_parts(rows, keys)
    return whole.select(
        "window_start", "window_end", *keys, F.size("books").cast("bigint").alias("book_count"), F.col("mean").alias("consensus_line"),
        F.col("low").alias("line_min"), F.col("high").alias("line_max"), F.sqrt(F.col("spread") / F.col("n")).alias("line_stddev"),
        (F.col("high") - F.col("low")).alias("line_range"),
        *([(F.col("prob_sum") / F.col("prob_n")).alias("consensus_prob")] if "prob_n" in whole.columns else []),
    )


# --- latest row per key ----------------------------------------------------------------------


def latest_per_key(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    path: str,
    checkpoint: str,
    *,
    cutoff: str | None = None,
    tie: Sequence[str] = (),
    bucket_bytes: int = BUCKET_BYTES,
    first_bits: int = FIRST_BITS,
) -> StreamingQuery:
    """Keep the latest snapshot per key (before its `cutoff` column, if given) in a table.

    Keys are dealt to buckets by the last bits of their hash. A batch adds its own rows, reduced and sorted, as one delta per
    bucket and rewrites nothing. Once a bucket's deltas are many, or hold as much as a good part of its base, they are merged
    with the base; a bucket beyond `bucket_bytes` becomes two by its next bit then. Rows of a key may lie in several parts, of
    which the latest wins, so an interrupted merge leaves nothing wrong and a retry writes the same parts. Read with
    `read_latest`.
    """
    source = stream if cutoff is None else stream.filter(F.col(ts) < F.col(cutoff).cast("timestamp"))
    schema = source.schema

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        delta, base = f"d{number:010d}", f"m{number:010d}"  # a merge sorts after all deltas and merges
        parts = _parts(spark, path)
        rows = latest_rows(batch, keys, ts, tie).withColumn("__hash", F.xxhash64(*keys))
        _write_parts(_dealt(rows, leaves(parts, first_bits)), keys, path, delta)
        due, wide = [], set()
        for bucket, held in _parts(spark, path).items():
            deltas = [p for p in held if p.startswith("d")]
            old = sum(size for p, size in held.items() if p.startswith("m"))
            new = sum(held[p] for p in deltas)
            if deltas and base not in held and (len(deltas) > DELTAS or new * GROWTH >= max(old, 1)):
                due.append(bucket)
                if old + new > bucket_bytes:
                    wide.add(bucket)
        if not due:
            return
        held = _parts(spark, path)
        names = [f"__bucket={b}/__part={p}" for b in due for p in held[b]]
        rows = latest_rows(_load(spark, schema, path, names), keys, ts, tie).withColumn("__hash", F.xxhash64(*keys))
        targets = [b for b in due if b not in wide] + [child for b in wide for child in _children(b)]
        _write_parts(_dealt(rows, targets), keys, path, base)
        remove(spark, [f"{path}/{n}" for n in names])

    return _run(source.writeStream.foreachBatch(merge), checkpoint)


def _parts(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """Bytes of each part, by bucket."""
    out: dict[str, dict[str, int]] = {}
    for name, size in folders(spark, path).items():
        place = _values(name)
        out.setdefault(place["__bucket"], {})[place["__part"]] = size
    return out


def _children(bucket: str) -> list[str]:
    bits, value = map(int, bucket.split("_"))
    return [f"{bits + 1}_{value}", f"{bits + 1}_{value + (1 << bits)}"]


def leaves(parts: Iterable[str], first_bits: int) -> list[str]:
    """The buckets, `bits_value`, that rows are dealt to: for every hash the deepest one there is."""
    held = {tuple(map(int, b.split("_"))) for b in parts}
    inner = {(bits, value % (1 << bits)) for deep, value in held for bits in range(first_bits, deep)}
    # A split makes both halves, also where one has got no row yet.
    whole = held | {(first_bits, v) for v in range(1 << first_bits)}
    whole |= {tuple(map(int, c.split("_"))) for bits, value in inner for c in _children(f"{bits}_{value}")}
    return [f"{bits}_{value}" for bits, value in sorted(whole - inner)]


def _dealt(rows: DataFrame, buckets: Sequence[str]) -> DataFrame:
    """Add the bucket of each row: one look-up in a table of buckets for each number of bits that occurs."""
    spark = rows.sparkSession
    depths = sorted({int(b.split("_")[0]) for b in buckets})
    spot = lambda bits: F.pmod("__hash", F.lit(1 << bits))
    choices = F.array(*[F.concat_ws("_", F.lit(str(bits)), spot(bits).cast("string")) for bits in depths])
    if len(depths) == 1:
        return rows.withColumn("__bucket", choices[0]).drop("__hash")
    table = spark.createDataFrame([(b,) for b in buckets], "__bucket string")
    return rows.withColumn("__bucket", F.explode(choices)).join(table, "__bucket").drop("__hash")


def _write_parts(rows: DataFrame, keys: Sequence[str], path: str, part: str) -> None:
    """One sorted file per bucket."""
    rows = rows.withColumn("__part", F.lit(part)).repartition("__bucket").sortWithinPartitions("__bucket", *keys)
    _replace(rows, path, "__bucket", "__part")


def read_latest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """The latest row of every key written by `latest_per_key`."""
    names = list(folders(spark, path))
    return latest_rows(_load(spark, schema, path, names), keys, ts, tie)


def to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Write a stream to Parquet, all available input at once."""
    return _run(stream.writeStream.format("parquet").outputMode(mode).option("path", path), checkpoint)


def drain(query: StreamingQuery, read: Callable[[], DataFrame]) -> DataFrame:
    """Wait for an available-now query to finish, then read its table."""
    query.awaitTermination()
    return read()
