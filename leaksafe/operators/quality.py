"""Data tests (failing rows out, none means pass), contracts, coverage and leakage zones."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or have a missing part, in one aggregation."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in keys])
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | missing)


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return df.filter(missing)


def in_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Rows whose value lies outside [low, high]; NULL passes, None leaves an end open."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return df.filter(bad)


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(col).isin(list(values)))


def relationships(df: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a parent. An anti join, so a NULL in the parent hides nothing."""
    return df.join(parent.select(*on).distinct(), list(on), "left_anti")


def before_event(df: DataFrame, events: DataFrame, on: Sequence[str], ts: str, event_ts: str) -> DataFrame:
    """Snapshots taken after their event."""
    return df.join(events.select(*on, event_ts), list(on), "inner").filter(F.col(ts) > F.col(event_ts))


def no_first_row_history(df: DataFrame, seq: str, cols: Sequence[str]) -> DataFrame:
    """First rows of a key that nevertheless carry history."""
    leaked = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    return df.filter((F.col(seq) == 1) & leaked)


def expression(df: DataFrame, must_hold: Column, where: Column | None = None) -> DataFrame:
    """Rows (that satisfy `where`) on which the expectation is false or unknown."""
    rows = df if where is None else df.filter(where)
    return rows.filter(~F.coalesce(must_hold, F.lit(False)))


def group_range(df: DataFrame, keys: Sequence[str], value: Column, low=None, high=None) -> DataFrame:
    return in_range(df.groupBy(*keys).agg(value.alias("value")), "value", low, high)


def has_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Names that the frame lacks."""
    missing = [(c,) for c in cols if c not in df.columns]
    return df.sparkSession.createDataFrame(missing, "column_name string")


def run(spark: SparkSession, checks: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """Run checks: one row each with name, status (PASS, FAIL, ERROR) and number of failing rows.

    A check is a function that returns its failing rows. One that cannot be analysed (say, a
    column is missing) is an ERROR, never a pass. The result is one lazy frame.
    """
    parts = []
    for name, build in checks.items():
        try:
            rows = build().agg(F.count(F.lit(1)).alias("rows"))
            parts.append(
                rows.select(
                    F.lit(name).alias("check_name"),
                    F.when(F.col("rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                    "rows",
                )
            )
        except AnalysisException:
            parts.append(
                spark.range(1).select(
                    F.lit(name).alias("check_name"), F.lit("ERROR").alias("status"), F.lit(None).cast("bigint").alias("rows")
                )
            )
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Rule:
    """A check of one table that shares its scan with the table's other rules.

    Exactly one of: `bad`, a condition that no row may meet; `unique`, columns that no two rows may share; `parent` with `on`, a
    table that must hold each row's columns. `where` limits the rows of a `bad` or `parent` rule.
    """

    table: str
    name: str
    bad: Column | None = None
    unique: tuple[str, ...] = ()
    parent: Callable[[], DataFrame] | None = None
    on: tuple[str, ...] = ()
    where: Column | None = None


def any_null(*cols: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def outside(col: str, low=None, high=None) -> Column:
    """NULL is not outside, and None leaves an end open."""
    ends = [F.col(col) < low] * (low is not None) + [F.col(col) > high] * (high is not None)
    return F.coalesce(reduce(lambda a, b: a | b, ends), F.lit(False))


def fails(must_hold: Column) -> Column:
    return ~F.coalesce(must_hold, F.lit(False))


def run_rules(spark: SparkSession, tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Run rules table by table, each table read once: rows as in `run`.

    Conditions are counted in one aggregate. Where a table has a `unique` rule, that aggregate is made per key first, before
    the shuffle, and then over the keys; further `unique` rules of a table read it again. Parents' distinct keys are
    joined to the rows, one match at most. A rule that cannot be analysed is an ERROR and leaves the others alone.
    """
    parts = []
    for name in dict.fromkeys(r.table for r in rules):
        mine = [r for r in rules if r.table == name]
        first = next((r for r in mine if r.unique), None)
        parts.append(_run_table(spark, tables, name, [r for r in mine if not r.unique or r is first]))
        parts += [_run_table(spark, tables, name, [r]) for r in mine if r.unique and r is not first]
    return reduce(DataFrame.unionByName, parts)


def _run_table(spark: SparkSession, tables: Mapping[str, DataFrame], name: str, rules: Sequence[Rule]) -> DataFrame:
    known, broken, counts, keys = [], [], {}, ()
    try:
        rows = tables[name]
    except (KeyError, AnalysisException):
        rows, broken = None, list(rules)
    for k, rule in enumerate([] if rows is None else rules):
        try:
            if rule.unique:
                rows.select(*rule.unique)
                keys = rule.unique
            else:
                bad, joined = rule.bad, rows
                if rule.parent is not None:
                    held = rule.parent().select(*[F.col(c).alias(f"__p{k}_{c}") for c in rule.on]).distinct()
                    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__p{k}_{c}") for c in rule.on])
                    joined = rows.join(held, same, "left")
                    bad = F.col(f"__p{k}_{rule.on[0]}").isNull()
                bad = bad if rule.where is None else bad & rule.where
                joined.select(bad)
                rows, counts[f"__c{k}"] = joined, F.count_if(F.coalesce(bad, F.lit(False)))
            known.append((rule.name, f"__c{k}"))
        except AnalysisException:
            broken.append(rule)
    out = [
        spark.range(1).select(F.lit(r.name).alias("check_name"), F.lit("ERROR").alias("status"), F.lit(None).cast("bigint").alias("rows"))
        for r in broken
    ]
    if known:
        own = [c.alias(n) for n, c in counts.items()]
        if keys:
            again = next(n for n, r in ((f"__c{k}", r) for k, r in enumerate(rules)) if r.unique)
            own += [F.count(F.lit(1)).alias("__n")]
            sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts] + [F.count_if(F.col("__n") > 1).alias(again)]
            one = rows.groupBy(*keys).agg(*own).agg(*sums)
        else:
            one = rows.agg(*own)
        each = F.array(*[F.struct(F.lit(label).alias("check_name"), F.col(n).alias("rows")) for label, n in known])
        one = one.select(F.inline(each))
        out.append(one.select("check_name", F.when(F.col("rows") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"), "rows"))
    return reduce(DataFrame.unionByName, out)


def stop_on_failure(results: DataFrame) -> DataFrame:
    """Raise with the names of the checks that did not pass (one row per check)."""
    bad = [f"{r['check_name']}: {r['status']}" for r in results.filter(F.col("status") != "PASS").collect()]
    if bad:
        raise ValueError("data tests failed: " + ", ".join(bad))
    return results


# --- contracts ------------------------------------------------------------------------------


class ContractViolation(ValueError):
    pass


@dataclass(frozen=True)
class Contract:
    """Required columns, their type family (None: any) and accepted values per column."""

    required: Mapping[str, str | None]
    accepted: Mapping[str, Sequence[str]] = field(default_factory=dict)
    lower: bool = False


# Fixed values.
ODDS = Contract(
    {
        "source_name": None, "sportsbook": None, "event_id": None, "market_timestamp": "timestamp",
        "game_datetime": None, "home_team": None, "away_team": None, "market_type": None, "selection": None,
        "line": "numeric", "price_american": "numeric", "snapshot_type": None, "ingestion_ts": None,
    },
    {
        "market_type": ("spread", "total", "moneyline", "team_total", "player_prop"),
        "snapshot_type": ("opening", "intraday", "closing"),
    },
)
WEATHER = Contract(
    {
        "source_name": None, "stadium_id": None, "latitude": "numeric", "longitude": "numeric",
        "observation_or_forecast_ts": None, "weather_type": None, "temperature_2m": "numeric",
        "wind_speed_10m": "numeric", "ingestion_ts": None,
    }
)
STADIUM = Contract(
    {
        "stadium_id": None, "stadium_name": None, "team": None, "latitude": None, "longitude": None,
        "elevation_m": None, "roof_type": None, "surface_type": None, "timezone": None,
    },
    {"roof_type": ("open", "dome", "retractable")},
    lower=True,
)

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _family(dtype: str) -> str:
    if dtype.startswith("timestamp"):
        return "timestamp"
    return "numeric" if dtype.split("(")[0] in _NUMERIC else dtype


def contract(df: DataFrame, rule: Contract, source: str = "") -> DataFrame:
    """Check the schema (raises on a missing column or wrong type); return unknown values with counts.

    The schema check needs no job. The returned warnings frame is lazy.
    """
    missing = [c for c in rule.required if c not in df.columns]
    if missing:
        raise ContractViolation(f"contract violation [{source}]: missing columns: {', '.join(missing)}")
    types = dict(df.dtypes)
    wrong = [c for c, t in rule.required.items() if t is not None and _family(types[c]) != t]
    if wrong:
        raise ContractViolation(f"contract violation [{source}]: wrong type: {', '.join(wrong)}")
    parts = []
    for col, values in rule.accepted.items():
        value = F.lower(F.col(col)) if rule.lower else F.col(col)
        unknown = df.select(value.alias("value")).filter(~F.col("value").isin(list(values)) | F.col("value").isNull())
        parts.append(
            unknown.groupBy("value").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(source).alias("source"), F.lit(col).alias("column_name"), "value", "rows"
            )
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "source string, column_name string, value string, rows bigint")
    return reduce(DataFrame.unionByName, parts)


def contract_report(df: DataFrame, rule: Contract, source: str = "") -> DataFrame:
    """A row per required column: whether it is there with the right type, its NULLs and its unknown values. One scan.

    Nothing is raised, so a feed that breaks its contract is reported whole.
    """
    types = dict(df.dtypes)
    counts, rows = [F.count(F.lit(1)).alias("__n")], []
    for i, (col, family) in enumerate(rule.required.items()):
        present = col in types
        value = F.lower(F.col(col)) if rule.lower and present else F.col(col)
        accepted = list(rule.accepted.get(col, ()))
        unknown = F.count_if(~value.isin(accepted)) if present and accepted else F.lit(0).cast("bigint")
        missing = F.count_if(F.col(col).isNull()) if present else F.count(F.lit(1))
        counts += [missing.alias(f"__m{i}"), unknown.alias(f"__u{i}")]
        kept = present and (family is None or _family(types[col]) == family)
        rows.append(
            F.struct(
                F.lit(source).alias("source"), F.lit(col).alias("column_name"), F.lit(present).alias("present"), F.lit(kept).alias("type_ok"),
                F.col(f"__m{i}").alias("missing"), F.col(f"__u{i}").alias("unknown"), F.col("__n").alias("rows"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


# --- coverage and registry ------------------------------------------------------------------


def coverage(df: DataFrame, period: Sequence[str], key: str, flags: Mapping[str, Column]) -> DataFrame:
    """Per period: distinct keys, and distinct keys for which each condition holds."""
    columns = [F.count_distinct(key).alias("total_keys")]
    columns += [F.count_distinct(F.when(cond, F.col(key))).alias(out) for out, cond in flags.items()]
    return df.groupBy(*period).agg(*columns)


_REGISTRY = (
    "source_category string, source_name string, enabled boolean, coverage_start int, coverage_end string, "
    "markets_available string, timestamp_granularity string, reliability_score double, notes string"
)


def source_registry(spark: SparkSession, sources: Iterable[Mapping]) -> DataFrame:
    """The configured sources as a table; absent settings are NULL, lists become comma-separated text."""
    names = [part.strip().split(" ")[0] for part in _REGISTRY.split(",")]
    rows = []
    for source in sources:
        row = dict(source)
        if isinstance(row.get("markets_available"), (list, tuple)):
            row["markets_available"] = ",".join(row["markets_available"])
        row["enabled"] = bool(row.get("enabled", False))
        rows.append(tuple(row.get(n) for n in names))
    return spark.createDataFrame(rows, _REGISTRY)


def registered_coverage(registry: DataFrame, rows: DataFrame, source: str, period: str) -> DataFrame:
    """What the tables hold of each registered source, and sources in them that nobody registered.

    `status` is ok, late (data begin after the registered start), absent, disabled (switched off, yet there are data) or
    unregistered.
    """
    held = rows.groupBy(F.col(source).alias("__source")).agg(
        F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.count(F.lit(1)).alias("rows")
    )
    out = registry.join(held, F.col("source_name") == F.col("__source"), "full_outer")
    status = (
        F.when(F.col("source_name").isNull(), "unregistered")
        .when(~F.col("enabled"), F.when(F.col("rows").isNull(), "off").otherwise("disabled"))
        .when(F.col("rows").isNull(), "absent")
        .when(F.col("first_period") > F.col("coverage_start"), "late")
        .otherwise("ok")
    )
    return out.select(
        F.coalesce("source_name", "__source").alias("source_name"), "enabled", "coverage_start", "first_period", "last_period",
        F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"),
    )


# --- leakage zones --------------------------------------------------------------------------

ALWAYS_SAFE, CONDITIONAL, NEVER = 1, 2, 3


def with_zone(df: DataFrame, zones: Mapping[str, int | tuple[int, float]]) -> DataFrame:
    """Tag columns with a leakage zone; zone 2 takes (2, hours before the event it is known at)."""
    for col, zone in zones.items():
        zone, hours = zone if isinstance(zone, tuple) else (zone, None)
        meta = {"zone": zone} if hours is None else {"zone": zone, "hours": hours}
        df = df.withMetadata(col, {**df.schema[col].metadata, **meta})
    return df


def zone_of(df: DataFrame, col: str) -> int:
    return df.schema[col].metadata.get("zone", ALWAYS_SAFE)


def assert_leakage_safe(df: DataFrame, horizon_hours: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Raise if a column is never predictive, or becomes known later than the horizon. No job is run."""
    bad = []
    for col in cols or df.columns:
        meta = df.schema[col].metadata
        zone = meta.get("zone", ALWAYS_SAFE)
        if zone == NEVER or (zone == CONDITIONAL and meta.get("hours", 0) < horizon_hours):
            bad.append(col)
    if bad:
        raise ValueError(f"not known {horizon_hours:g} h before the event: {', '.join(bad)}")
    return df
