"""Ordered windows that survive a key holding a large share of all rows.

A plain `Window.partitionBy(key)` puts every row of one key into one task. Here a key with
more rows than one task should take (a *hot* key) is cut into consecutive blocks of its own
order. Each block is one window partition; what a block needs from its neighbours is handed
over in one of two ways:

* `Running` aggregates get the total of all earlier blocks (one row per block),
* `Frame` aggregates get the few neighbouring rows the frame can reach (a halo).

All other keys take the ordinary window, in the same shuffle. Where no key is hot the result
is exactly one shuffle, one sort and one Window node.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from leaksafe.session import checkpoint

ROWS_PER_TASK = 4_000_000
SAMPLES_PER_BLOCK = 16
BROADCAST_CUTS = 200_000  # rows of keys, bounds and totals that may be broadcast

_ALL = "__all"
_BLOCK = "__block"
_HALO = "__halo"
_AT = "__at"


@dataclass(frozen=True)
class Running:
    """Aggregate over every earlier row of the key; `inclusive` adds the current row.

    `agg` is one of sum, count, avg, min, max, last (last non-NULL). `col=None` counts rows.
    """

    agg: str
    col: str | Column | None = None
    inclusive: bool = False


@dataclass(frozen=True)
class Frame:
    """Aggregate over the rows `start..end` relative to the current one, e.g. (-5, -1).

    `agg` is one of sum, count, avg, min, max, first. `Frame("first", c, -1, -1)` is a lag.
    """

    agg: str
    col: str | Column | None
    start: int
    end: int


@dataclass(frozen=True)
class HotKeys:
    """The blocks of a frame's hot keys; both tables are None if no key is hot.

    `coarse` holds consecutive ranges per key, `fine` the blocks of each range.
    """

    keys: tuple[str, ...]
    coarse: DataFrame | None = None
    fine: DataFrame | None = None


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _position(order: Sequence[str]) -> Column:
    """The order columns as one comparable struct, NULL last."""
    fields = []
    for i, name in enumerate(order):
        fields.append(F.col(name).isNull().alias(f"n{i}"))
        fields.append(F.col(name).alias(f"v{i}"))
    return F.struct(*fields)


def profile(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    *,
    rows_per_task: int | None = None,
) -> HotKeys:
    """Find the keys too large for one task, and where to cut them.

    One partial aggregation counts rows per key; every key above `rows_per_task` is cut. Cut points
    come from a sample of those keys' rows, `SAMPLES_PER_BLOCK` a block, ordered by a window per key.
    They decide the balance of the tasks and never the result. Counts and cuts stay in tables: the
    driver only learns whether there are any.
    """
    names = _names(keys)
    limit = rows_per_task or ROWS_PER_TASK
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    hot = checkpoint(counts.withColumn("__blocks", F.ceil(F.col("__n") / limit)))
    if hot.isEmpty():
        return HotKeys(tuple(names))

    wide = hot.withColumnsRenamed({n: f"__k_{n}" for n in names})
    placed = df.select(*names, _position(_names(order)).alias(_AT))
    # A row is in the sample by its own hash, so that a task that runs twice picks the same rows.
    share = F.least(F.lit(1.0), SAMPLES_PER_BLOCK * F.col("__blocks") / F.col("__n"))
    draw = F.pmod(F.xxhash64(F.lit(7), *names, _AT), F.lit(1 << 20)) / float(1 << 20)
    sample = placed.join(_sized(wide), _null_safe(names), "inner").filter(draw < share).select(*names, _AT, "__blocks")
    own = Window.partitionBy(*names)
    slot = F.floor((F.row_number().over(own.orderBy(_AT)) - 1) * F.col("__blocks") / F.count(F.lit(1)).over(own))
    cuts = (
        sample.withColumn("__slot", slot).filter(F.col("__slot") > 0)
        .groupBy(*names, "__slot").agg(F.min(_AT).alias("__lo"))
        .groupBy(*names, "__lo").agg(F.min("__slot").alias("__slot"))
    )
    # The block before the first cut has no lower bound, the one after the last no upper bound.
    empty = F.lit(None).cast(placed.schema[_AT].dataType)
    edges = cuts.unionByName(hot.select(*names, empty.alias("__lo"), F.lit(0).cast("bigint").alias("__slot")))
    by_slot = own.orderBy("__slot")
    fine = edges.select(
        *names, "__lo", F.lead("__lo").over(by_slot).alias("__hi"),
        (F.row_number().over(by_slot) - 1).cast("int").alias(_BLOCK), F.count(F.lit(1)).over(own).alias("__edges"),
    )
    # Ranges of about as many blocks as there are ranges: a row meets few bounds on either level.
    fan = F.ceil(F.sqrt("__edges"))
    fine = checkpoint(fine.withColumn("__range", F.floor(F.col(_BLOCK) / fan).cast("int")).drop("__edges"))
    coarse = fine.groupBy(*names, "__range").agg(
        F.min_by("__lo", _BLOCK).alias("__lo"), F.max_by("__hi", _BLOCK).alias("__hi")
    )
    return HotKeys(tuple(names), coarse, fine)


def _sized(table: DataFrame) -> DataFrame:
    """Broadcast a table of cuts if it is counted and small; otherwise Spark joins it as it sees fit."""
    return F.broadcast(table) if table.count() <= BROADCAST_CUTS else table


def _reached(order: Sequence[str], bound: str) -> Column:
    """Whether the row's position is at or after a bound, NULL last, compared column by column."""
    result = F.lit(True)
    for i, name in reversed(list(enumerate(order))):
        here, there = F.col(name), F.col(f"{bound}.v{i}")
        after = F.coalesce(here > there, here.isNull() & there.isNotNull())
        result = after | (here.eqNullSafe(there) & result)
    return result


def _inside(order: Sequence[str]) -> Column:
    above = F.col("__lo").isNull() | _reached(order, "__lo")
    return above & (F.col("__hi").isNull() | ~_reached(order, "__hi"))


def _place(df: DataFrame, names: Sequence[str], order: Sequence[str], hot: HotKeys, how: str) -> DataFrame:
    """Add the block of each hot row. Two lookups by key: the range, then the block within it.

    A key of n blocks has about the root of n ranges, so a row meets about twice that many bounds.
    """
    table = _sized(hot.coarse.withColumnsRenamed({n: f"__k_{n}" for n in names}))
    df = df.join(table, _null_safe(names) & _inside(order), how).drop("__lo", "__hi", *[f"__k_{n}" for n in names])
    table = _sized(hot.fine.withColumnsRenamed({**{n: f"__k_{n}" for n in names}, "__range": "__k___range"}))
    same = _null_safe(names) & (F.col("__range") == F.col("__k___range"))
    return df.join(table, same & _inside(order), how).drop(
        "__lo", "__hi", "__range", "__k___range", *[f"__k_{n}" for n in names]
    )


def _aggregate(agg: str, value: Column | None) -> Column:
    if agg == "count":
        return F.count(F.lit(1) if value is None else value)
    if agg == "last":
        return F.last(value, ignorenulls=True)
    return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "first": F.first}[agg](value)


def _spec(keys: Sequence[str], order: Sequence[str], descending: bool) -> WindowSpec:
    ordering = [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in order]
    return Window.partitionBy(*keys).orderBy(*ordering)


def _over(item: Running | Frame, value: Column | None, window: WindowSpec) -> Column:
    if isinstance(item, Running):
        window = window.rowsBetween(Window.unboundedPreceding, 0 if item.inclusive else -1)
    else:
        window = window.rowsBetween(item.start, item.end)
    return _aggregate(item.agg, value).over(window)


def ordered(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    outputs: Mapping[str, Running | Frame],
    *,
    descending: bool = False,
    hot: HotKeys | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add one column per entry of `outputs`, computed over each key's rows in `order`.

    `order` must be a total order within the key (end it with a tie-break column). With
    `keys=[]` the whole frame is one ordered sequence. `hot` takes a `profile` made earlier
    (or on a cheaper frame with the same keys and order); without it one is made here.
    """
    names, order = _names(keys), _names(order)
    drop = []
    if not names:
        names, drop = [_ALL], [_ALL]
        df = df.withColumn(_ALL, F.lit(0))
    if hot is None:
        hot = profile(df, names, order, rows_per_task=rows_per_task)
    if hot.fine is None:
        window = _spec(names, order, descending)
        added = [
            _over(item, None if item.col is None else _column(item.col), window).alias(name)
            for name, item in outputs.items()
        ]
        return df.select("*", *added).drop(*drop)
    return _blocked(df, names, order, outputs, descending, hot).drop(*drop)


def global_rank(df: DataFrame, order: Sequence[str], rank: str = "rank", total: str = "total") -> DataFrame:
    """Add the position of each row in the whole frame, from 1, and the number of rows.

    `order` must be a total order. Rows are dealt to ranges of it and sorted there, whatever their number, so equal values
    spread over tasks as the later columns of `order` tell them apart. Positions within a range and one count per
    range add up. The dealt rows are kept in the checkpoint folder, for ranges are drawn by sampling and both the counts
    and the rows must see the same.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__id", F.monotonically_increasing_id())
    placed = checkpoint(placed).withColumns({"__range": F.shiftright("__id", 33), "__place": F.col("__id").bitwiseAND((1 << 33) - 1)})
    counts = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("__range")  # one row per range
    sums = counts.select(
        "__range", F.coalesce(F.sum("__n").over(by_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(F.lit(0))).alias(total),
    )
    out = placed.join(F.broadcast(sums), "__range").withColumn(rank, F.col("__before") + F.col("__place") + 1)
    return out.select(*df.columns, rank, total)


def _blocked(df, names, order, outputs, descending, hot) -> DataFrame:
    columns = df.columns
    # A plain column is its own measure; expressions and row counts become columns of their own.
    measures, added = {}, []
    for i, (name, item) in enumerate(outputs.items()):
        measures[name] = item.col if isinstance(item.col, str) else None if item.col is None else f"__m{i}"
        if isinstance(item.col, Column):
            added.append(item.col.alias(f"__m{i}"))
    source = df.select("*", *added)
    rows = _place(source, names, order, hot, "left").withColumn(_BLOCK, F.coalesce(_BLOCK, F.lit(-1)))
    hot_rows = _place(source, names, order, hot, "inner").withColumn(_AT, _position(order))
    grain = [*names, _BLOCK]

    before = max([-i.start for i in outputs.values() if isinstance(i, Frame)] + [0])
    after = max([i.end for i in outputs.values() if isinstance(i, Frame)] + [0])
    if descending:
        before, after = after, before
    carried = [measures[n] for n, i in outputs.items() if isinstance(i, Frame) and measures[n]]
    halo = F.lit(False)
    if before > 0 or after > 0:
        rows, halo = rows.withColumn(_HALO, F.lit(False)), F.col(_HALO)
    for reach, earlier in ((before, True), (after, False)):
        if reach > 0:
            rows = rows.unionByName(_halo(hot_rows, names, order, carried, reach, earlier), allowMissingColumns=True)

    window = _spec(grain, order, descending)
    inner = {}
    for name, item in outputs.items():
        measure = None if measures[name] is None else F.col(measures[name])
        if isinstance(item, Running):
            measure = F.when(~halo, F.lit(1) if measure is None else measure)
            if item.agg == "avg":
                inner[f"__s_{name}"] = _over(Running("sum", inclusive=item.inclusive), measure, window)
                inner[f"__c_{name}"] = _over(Running("count", inclusive=item.inclusive), measure, window)
                continue
        inner[f"__i_{name}"] = _over(item, measure, window)
    rows = rows.select("*", *[c.alias(n) for n, c in inner.items()]).filter(~halo)

    carry = _carry(hot_rows, names, outputs, measures, descending)
    if carry is None:
        return rows.select(*columns, *[F.col(f"__i_{n}").alias(n) for n in outputs])
    # One row per hot key and block, of whatever width the outputs have: Spark decides how to join it.
    carry = carry.withColumnsRenamed({n: f"__k_{n}" for n in grain})
    rows = rows.join(carry, _null_safe(grain), "left")
    final = []
    for name, item in outputs.items():
        if isinstance(item, Frame):
            value = F.col(f"__i_{name}")
        elif item.agg == "avg":
            count = F.col(f"__c_{name}") + F.coalesce(F.col(f"__cc_{name}"), F.lit(0))
            total = F.coalesce(F.col(f"__s_{name}"), F.lit(0)) + F.coalesce(F.col(f"__cs_{name}"), F.lit(0))
            value = F.when(count > 0, total.cast("double") / count)
        else:
            here, earlier = F.col(f"__i_{name}"), F.col(f"__ci_{name}")
            if item.agg == "sum":
                value = F.coalesce(here + earlier, here, earlier)
            elif item.agg == "count":
                value = here + F.coalesce(earlier, F.lit(0))
            elif item.agg == "min":
                value = F.least(here, earlier)
            elif item.agg == "max":
                value = F.greatest(here, earlier)
            else:
                value = F.coalesce(here, earlier)
        final.append(value.alias(name))
    return rows.select(*columns, *final)


def _null_safe(names) -> Column:
    condition = F.lit(True)
    for n in names:
        condition = condition & F.col(n).eqNullSafe(F.col(f"__k_{n}"))
    return condition


def _carry(hot_rows, names, outputs, measures, descending) -> DataFrame | None:
    """Per hot key and block: each running aggregate over all blocks that come before it."""
    parts, later = {}, {}
    for name, item in outputs.items():
        if isinstance(item, Frame):
            continue
        value = F.lit(1) if measures[name] is None else F.col(measures[name])
        if item.agg == "avg":
            parts[f"__cs_{name}"], later[f"__cs_{name}"] = F.sum(value), F.sum
            parts[f"__cc_{name}"], later[f"__cc_{name}"] = F.count(value), F.sum
        elif item.agg == "last":
            known = F.when(value.isNotNull(), F.col(_AT))
            parts[f"__ci_{name}"] = F.min_by(value, known) if descending else F.max_by(value, known)
            later[f"__ci_{name}"] = lambda c: F.last(c, ignorenulls=True)
        else:
            parts[f"__ci_{name}"] = _aggregate(item.agg, value)
            later[f"__ci_{name}"] = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}[item.agg]
    if not parts:
        return None
    totals = hot_rows.groupBy(*names, _BLOCK).agg(*[c.alias(n) for n, c in parts.items()])
    by_block = F.col(_BLOCK).desc() if descending else F.col(_BLOCK).asc()
    window = Window.partitionBy(*names).orderBy(by_block).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*names, _BLOCK, *[f(F.col(n)).over(window).alias(n) for n, f in later.items()])


def _halo(hot_rows, names, order, carried, reach, earlier) -> DataFrame:
    """The `reach` rows just before (or after) each block, filed under that block."""
    edge = _spec([*names, _BLOCK], order, descending=earlier)
    fields = list(dict.fromkeys([_AT, *order, *carried]))
    fields = [f for f in fields if f not in names]
    edges = (
        hot_rows.withColumn("__rn", F.row_number().over(edge))
        .filter(F.col("__rn") <= reach)
        .groupBy(*names, _BLOCK)
        .agg(F.collect_list(F.struct(*fields)).alias("__edge"))  # at most `reach` rows
    )
    # Every block holds at least one row, so `reach` neighbouring blocks hold enough rows.
    near = Window.partitionBy(*names).orderBy(_BLOCK)
    near = near.rowsBetween(-reach, -1) if earlier else near.rowsBetween(1, reach)
    rows = edges.select(*names, _BLOCK, F.flatten(F.collect_list("__edge").over(near)).alias("__near"))
    ranked = F.sort_array("__near", asc=not earlier)
    return (
        rows.select(*names, _BLOCK, F.explode(F.slice(ranked, 1, reach)).alias("__row"))
        .select(*names, _BLOCK, *[F.col(f"__row.{f}").alias(f) for f in fields if f != _AT])
        .withColumn(_HALO, F.lit(True))
    )
