"""Queries over refreshes by content, contracts, sources, logs, files and reports over several groupings."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaksafe.operators import dash, evaluate, quality
from leaksafe.operators.marts import temporal_split
from leaksafe.plans import relation_sql
from leaksafe.plans.queries_reports import PREDICTED_SQL, REGRESSION_SQL, predicted
from leaksafe.plans.registry import query, table
from leaksafe.plans.relations import relations, scratch
from leaksafe.sources import payloads, tables


def _by_year(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("season"))


@query(
    "refresh_by_content",
    """
    WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_totalprice, (year(o_orderdate) % 4 = 3) AS late, (year(o_orderdate) % 4 = 1) AS changed FROM orders)
    SELECT season, COUNT(*) AS rows, MIN(CASE WHEN late THEN 'new' WHEN changed THEN 'rewritten' ELSE 'unchanged' END) AS status,
      ROUND(SUM(CASE WHEN changed THEN 2 * o_totalprice ELSE o_totalprice END), 2) AS total
    FROM o GROUP BY season
    """,
)
def refresh_by_content(spark, sf):
    """Load some years, then reload all of them in another order with some changed: only those and the new ones are written."""
    out = f"{scratch(spark, 'content')}/orders"
    orders = _by_year(spark, sf)
    tables.refresh_changed(orders.filter("season % 4 <> 3"), out, ["season"])
    price = F.when(F.col("season") % 4 == 1, 2 * F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    again = orders.withColumn("o_totalprice", price).repartition(3, "o_orderkey")
    report = tables.refresh_changed(again, out, ["season"])
    held = tables.read_table(spark, out).groupBy("season").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return report.join(held, "season").select(F.col("season").cast("int").alias("season"), "rows", "status", "total")


SETS = [[], ["priority"], ["status"], ["season"], ["split"], ["split", "status"], ["season", "priority"]]


@query(
    "report_by_sets",
    f"""
    WITH {PREDICTED_SQL},
    d AS (SELECT o_orderpriority AS priority, o_orderstatus AS status, CAST(season AS VARCHAR) AS season,
            CASE WHEN season < 1998 THEN 'train' WHEN season <= 1999 THEN 'validation' ELSE 'test' END AS split, actual, pred FROM p)
    SELECT concat_ws('+', CASE WHEN GROUPING(priority) = 0 THEN 'priority' END, CASE WHEN GROUPING(status) = 0 THEN 'status' END,
        CASE WHEN GROUPING(season) = 0 THEN 'season' END, CASE WHEN GROUPING(split) = 0 THEN 'split' END) AS "grouping",
      priority, status, season, split, {REGRESSION_SQL}
    FROM d GROUP BY GROUPING SETS ({", ".join("(" + ", ".join(s) + ")" for s in SETS)})
    """,
)
def report_by_sets(spark, sf):
    rows = predicted(spark, sf)
    dims = {"priority": "o_orderpriority", "status": "o_orderstatus", "season": F.col("season"), "split": temporal_split("season", 1998, 1999)}
    out = evaluate.by_sets(rows, "actual", "pred", dims, SETS).drop("sd_pred", "sd_actual")
    return out.withColumns({c: F.round(c, 6) for c in ("rmse", "mae", "bias", "r2")})


def _contract_sql(source: str, columns: dict[str, str], relation: str, accepted: dict[str, tuple[str, ...]]) -> str:
    part = (
        "SELECT '{source}' AS source, '{name}' AS column_name, {there} AS present, {there} AS type_ok, "
        "CAST(COUNT(*) {missing} AS BIGINT) AS missing, {unknown} AS unknown, COUNT(*) AS rows FROM {relation}"
    )
    parts = []
    for name, col in columns.items():
        values = ", ".join(f"'{v}'" for v in accepted.get(name, ()))
        parts.append(
            part.format(
                source=source, name=name, relation=relation, there="TRUE" if col else "FALSE",
                missing=f"FILTER (WHERE {col} IS NULL)" if col else "",
                unknown=f"COUNT(*) FILTER (WHERE lower({col}) NOT IN ({values}))" if values else "CAST(0 AS BIGINT)",
            )
        )
    return relation_sql.compose(relation, " UNION ALL ".join(parts))


STADIUM_COLUMNS = {c: c for c in quality.STADIUM.required}
# The contract's names for what the hourly relation holds; it keeps no ingestion time.
WEATHER_COLUMNS = {
    "source_name": "source_name", "stadium_id": "stadium_id", "latitude": "latitude", "longitude": "longitude",
    "observation_or_forecast_ts": "weather_ts", "weather_type": "weather_type", "temperature_2m": "temp_f",
    "wind_speed_10m": "wind_mph", "ingestion_ts": "",
}


@query("stadium_contract", _contract_sql("stadium", STADIUM_COLUMNS, "stg_stadium", quality.STADIUM.accepted))
def stadium_contract(spark, sf):
    return quality.contract_report(relations(spark, sf)["stg_stadium"], quality.STADIUM, "stadium")


@query("weather_contract", _contract_sql("weather", WEATHER_COLUMNS, "stg_weather_game_hourly", {}))
def weather_contract(spark, sf):
    rows = relations(spark, sf)["stg_weather_game_hourly"]
    rows = rows.select(*[F.col(c).alias(name) for name, c in WEATHER_COLUMNS.items() if c])
    return quality.contract_report(rows, quality.WEATHER, "weather")


REGISTRY = [
    {"source_category": "odds", "source_name": "src0", "enabled": True, "coverage_start": 2010, "markets_available": ["spread", "total"]},
    {"source_category": "odds", "source_name": "src1", "enabled": False, "coverage_start": 2010},
    {"source_category": "odds", "source_name": "src2", "enabled": True, "coverage_start": 2030},
    {"source_category": "odds", "source_name": "nowhere", "enabled": True, "coverage_start": 2010},
]


@query(
    "source_registry",
    relation_sql.compose(
        "stg_market_game_line",
        "SELECT COALESCE(r.source_name, h.source_name) AS source_name, enabled, coverage_start, first_period, last_period, COALESCE(h.rows, 0) AS rows, "
        "CASE WHEN r.source_name IS NULL THEN 'unregistered' WHEN NOT enabled THEN CASE WHEN h.rows IS NULL THEN 'off' ELSE 'disabled' END "
        "WHEN h.rows IS NULL THEN 'absent' WHEN first_period > coverage_start THEN 'late' ELSE 'ok' END AS status FROM (VALUES "
        + ", ".join(f"('{r['source_name']}', {r['enabled']}, {r['coverage_start']})" for r in REGISTRY)
        + ") r(source_name, enabled, coverage_start) FULL JOIN (SELECT source_name, MIN(season) AS first_period, MAX(season) AS last_period, "
        "COUNT(*) AS rows FROM stg_market_game_line GROUP BY 1) h ON r.source_name = h.source_name",
    ),
)
def source_registry(spark, sf):
    registry = quality.source_registry(spark, REGISTRY)
    return quality.registered_coverage(registry, relations(spark, sf)["stg_market_game_line"], "source_name", "season")


@query(
    "tracking_log",
    relation_sql.compose(
        "stg_nextgen_player_week",
        "SELECT player_id, season, week, targets, receptions, ROUND(avg_separation, 4) AS avg_separation, ROUND(avg_cushion, 4) AS avg_cushion "
        "FROM stg_nextgen_player_week WHERE stat_type = 'receiving' AND week > 0 AND lower(full_name) LIKE '%player 3%'",
    ),
)
def tracking_log(spark, sf):
    """Week by week, the tracked receiving figures of the players a search finds."""
    rows = dash.search(relations(spark, sf)["stg_nextgen_player_week"], "full_name", "player 3")
    where = (F.col("stat_type") == "receiving") & (F.col("week") > 0)
    plain = {c: c for c in ("player_id", "season", "week", "targets", "receptions")}
    rounded = {c: F.round(c, 4) for c in ("avg_separation", "avg_cushion")}
    return dash.log(rows, where, ["player_id", "season", "week"], {**plain, **rounded})


@query(
    "external_frame",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(year(o_orderdate) AS INTEGER) AS season_in_path, COUNT(*) AS rows, ROUND(SUM(o_totalprice), 2) AS total
    FROM orders GROUP BY 1
    """,
)
def external_frame(spark, sf):
    """A frame made elsewhere is accepted and written by season; each file's path tells the season as its rows do."""
    out = f"{scratch(spark, 'external')}/orders"
    payloads.ingest_external(_by_year(spark, sf), ["season", "o_orderkey"], out)
    rows = tables.read_table(spark, out).select("season", "o_totalprice", tables.path_part("season", "int").alias("season_in_path"))
    return rows.groupBy("season", "season_in_path").agg(F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "alternating_file",
    """
    WITH n AS (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS i, o_custkey % 32 AS team, strftime(o_orderdate, '%-m/%-d/%Y') AS day, CAST(o_orderdate AS DATE) AS date,
                CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE (o_custkey % 21) / 2.0 END AS open, (o_custkey % 23) / 2.0 AS close FROM orders),
    g AS (SELECT a.team AS away, h.team AS home, h.date AS date, h.open AS home_open, h.close AS home_close, a.open AS away_open, a.close AS away_close
          FROM n a JOIN n h ON a.i % 2 = 0 AND h.i = a.i + 1),
    l AS (SELECT *, 'spread' AS market_type, 'home' AS selection, 'opening' AS snapshot_type, home_open AS line FROM g
          UNION ALL SELECT *, 'spread', 'home', 'closing', home_close FROM g UNION ALL SELECT *, 'total', 'over', 'opening', away_open FROM g
          UNION ALL SELECT *, 'total', 'over', 'closing', away_close FROM g)
    SELECT '2020_' || strftime(date, '%Y%m%d') || '_T' || home || '_T' || away AS event_id, market_type, selection, snapshot_type, CAST(line AS DOUBLE) AS line,
      CAST(away_close AS DOUBLE) AS overunder_line, -110 AS price_american FROM l
    """,
)
def alternating_file(spark, sf):
    """A CSV file whose rows alternate between visitor and home team, read back and paired into games and their lines."""
    orders = table(spark, sf, "orders")
    numbered = payloads.numbered(orders, ["o_orderkey"])
    team = F.concat(F.lit("T"), (F.col("o_custkey") % 32).cast("string"))
    rows = numbered.select(
        F.col("line_no"), F.date_format("o_orderdate", "M/d/yyyy").alias("date"), team.alias("team"),
        F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_custkey") % 21) / 2).cast("string").alias("open"),
        ((F.col("o_custkey") % 23) / 2).cast("string").alias("close"),
    )
    out = scratch(spark, "alternating")
    tables.write_report(rows, out)
    file = payloads.csv_table(spark, out, "line_no long, date string, team string, open string, close string")
    return payloads.alternating_lines(file, "line_no", 2020).select(
        "event_id", "market_type", "selection", "snapshot_type", "line", "overunder_line", "price_american"
    )
