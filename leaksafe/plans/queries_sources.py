"""Queries over the read and write paths, payload adapters, contracts and model preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaksafe.operators import evaluate, ml, quality
from leaksafe.plans.registry import query, table
from leaksafe.plans.relations import scratch
from leaksafe.sources import payloads, tables


def _yearly(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("season"))


@query(
    "partition_refresh",
    """
    WITH o AS (SELECT o_orderkey, year(o_orderdate) AS season, o_totalprice, (year(o_orderdate) = m OR year(o_orderdate) % 3 = 0) AS again FROM orders, (SELECT MAX(year(o_orderdate)) AS m FROM orders))
    SELECT CAST(season AS INTEGER) AS season, COUNT(*) AS rows, ROUND(SUM(CASE WHEN again THEN 2 * o_totalprice ELSE o_totalprice END), 2) AS total, MIN(CASE WHEN again THEN 'second' ELSE 'first' END) AS loaded
    FROM o GROUP BY season
    """,
)
def partition_refresh(spark, sf):
    """Load all partitions but every third, then plan a refresh: what is missing and the latest one, and load these anew."""
    out = scratch(spark, "partitions")
    orders = _yearly(spark, sf)
    first, last = orders.agg(F.min("season"), F.max("season")).first()
    if first is None:
        return orders.groupBy("season").agg(F.count("*").alias("rows"), F.sum("o_totalprice").alias("total"), F.lit("first").alias("loaded"))
    loaded = orders.filter("season % 3 <> 0")
    payloads.load_partitions(loaded, out, "orders", "first")
    wanted = tables.resolve_periods(f"{first}:current", last)
    todo = tables.partitions_to_refresh(tables.existing_partitions(spark, out, "season"), wanted, [last])
    again = orders.filter(F.col("season").isin(todo)).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    payloads.load_partitions(again, out, "orders", "second")
    rows = tables.canonical_cast(tables.read_table(spark, out))
    return rows.groupBy("season").agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("source_file_type").alias("loaded")
    )


@query(
    "filtered_scan",
    """
    SELECT o_orderstatus, COUNT(*) AS rows, COUNT(*) FILTER (year(o_orderdate) % 2 = 0) AS even, CAST(0 AS BIGINT) AS stub_rows
    FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY o_orderstatus
    """,
)
def filtered_scan(spark, sf):
    """A partitioned table read by column name through a view, with a filter on the partitions, beside a table that is absent."""
    out = scratch(spark, "scan")
    # Two writes whose columns come in other orders.
    orders = _yearly(spark, sf)
    tables.write_table(orders.filter("season % 2 = 0"), f"{out}/orders", partition=["season"])
    tables.write_table(orders.filter("season % 2 = 1").select("o_orderstatus", "season", "o_totalprice", "o_orderkey"), f"{out}/orders", partition=["season"])
    found = tables.register_all(spark, {"scan_orders": f"{out}/orders", "scan_absent": f"{out}/absent"})
    absent = tables.read_or_stub(spark, f"{out}/absent", "o_orderstatus string, o_orderkey long")
    assert found == ["scan_orders"]
    rows = tables.read_table(spark, f"{out}/orders", where="season >= 1996").groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.count_if(F.col("season") % 2 == 0).alias("even")
    )
    stub = absent.groupBy("o_orderstatus").agg(F.count("*").alias("stub_rows"))
    return rows.join(stub, "o_orderstatus", "left").withColumn("stub_rows", F.coalesce("stub_rows", F.lit(0).cast("bigint")))


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_mktsegment, ROUND(c_acctbal, 2) AS c_acctbal, c_name FROM customer",
)
def csv_round_trip(spark, sf):
    out = scratch(spark, "csv")
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_name")
    tables.write_report(customers, out, "csv")
    back = payloads.csv_table(spark, out, customers.schema)
    return back.withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(
    "odds_payload",
    """
    SELECT 'E' || o_orderkey AS event_id, 'T' || o_custkey % 50 AS home_team, 'T' || (o_custkey % 50 + 1) AS away_team, 'B' || l_suppkey % 3 AS sportsbook,
      CASE l_linenumber % 3 WHEN 0 THEN 'moneyline' WHEN 1 THEN 'spread' ELSE 'total' END AS market_type,
      CASE l_linenumber % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' ELSE 'over' END AS selection,
      CAST(CASE WHEN l_quantity % 2 = 0 THEN 100 + l_quantity ELSE -100 - l_quantity END AS INTEGER) AS price_american, CAST(l_discount AS DOUBLE) AS line,
      ROUND(CASE WHEN l_quantity % 2 = 0 THEN 1 + (100 + l_quantity) / 100 ELSE 1 + 100 / (100 + l_quantity) END, 6) AS price_decimal
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
)
def odds_payload(spark, sf):
    """Line items packed into market payloads, one per order, and unpacked by the adapter."""
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    home, away = (F.concat(F.lit("T"), (F.col("o_custkey") % 50 + k).cast("string")) for k in (0, 1))
    kind = F.col("l_linenumber") % 3
    price = F.when(F.col("l_quantity") % 2 == 0, 100 + F.col("l_quantity")).otherwise(-100 - F.col("l_quantity")).cast("double")
    outcome = F.struct(F.when(kind == 0, home).when(kind == 1, away).otherwise("Over").alias("name"), price.alias("price"), F.col("l_discount").cast("double").alias("point"))
    market = F.struct(F.when(kind == 0, "h2h").when(kind == 1, "spreads").otherwise("totals").alias("key"), F.array(outcome).alias("outcomes"))
    book = F.struct(F.concat(F.lit("B"), (F.col("l_suppkey") % 3).cast("string")).alias("key"), F.lit("2024-01-01T00:00:00Z").alias("last_update"), F.array(market).alias("markets"))
    event = F.struct(
        F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("id"), F.lit("2024-01-02T00:00:00Z").alias("commence_time"),
        home.alias("home_team"), away.alias("away_team"), F.collect_list(book).alias("bookmakers"),
    )
    packed = lines.groupBy("o_orderkey", "o_custkey").agg(event.alias("e"))
    rows = payloads.odds_payload(packed.select(F.to_json(F.array("e")).alias("body"), F.lit("2024-01-01").cast("timestamp").alias("fetched_at")), "body")
    return rows.select(
        "event_id", "home_team", "away_team", "sportsbook", "market_type", "selection", "price_american", "line", F.round("price_decimal", 6).alias("price_decimal")
    )


@query(
    "hourly_payload",
    """
    SELECT user_id, ROUND(value, 6) AS temperature_2m, ROUND(value / 25.4, 6) AS precipitation, CAST(event_id % 90 AS INTEGER) AS weather_code,
      date_trunc('second', ts) AS at, 'forecast' AS weather_type FROM events
    """,
)
def hourly_payload(spark, sf):
    """Events packed into weather payloads of parallel arrays, one per user, and unpacked by the adapter."""
    events = table(spark, sf, "events")
    item = F.sort_array(F.collect_list(F.struct("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"), "value")))
    packed = events.groupBy("user_id").agg(item.alias("x"))
    hourly = F.struct(
        F.transform("x", lambda e: e["time"]).alias("time"), F.transform("x", lambda e: e["value"]).alias("temperature_2m"),
        F.transform("x", lambda e: e["value"]).alias("precipitation"),
        F.transform("x", lambda e: (e["event_id"] % 90).cast("double")).alias("weather_code"),
    )
    body = packed.select("user_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("body"))
    rows = payloads.hourly_payload(body, "body", ["user_id"], "forecast", precipitation_unit="mm")
    return rows.select(
        "user_id", F.round("temperature_2m", 6).alias("temperature_2m"), F.round("precipitation", 6).alias("precipitation"), "weather_code",
        F.col("observation_or_forecast_ts").cast("timestamp_ntz").alias("at"), "weather_type",
    )


@query(
    "contract_lines",
    """
    SELECT 'lines' AS source, 'market_type' AS column_name, 'kind' || l_linenumber AS value, COUNT(*) AS rows FROM lineitem WHERE l_linenumber NOT IN (1, 2) GROUP BY l_linenumber
    UNION ALL
    SELECT 'lines', 'snapshot_type', l_linestatus, COUNT(*) FROM lineitem WHERE l_linestatus <> 'O' GROUP BY l_linestatus
    """,
)
def contract_lines(spark, sf):
    """Line items under the market contract: the schema passes, values outside the accepted ones are counted."""
    number = F.col("l_linenumber")
    modes = F.when(number == 1, "spread").when(number == 2, "total").otherwise(F.concat(F.lit("kind"), number.cast("string")))
    fixed = {c: F.lit(c) for c in ("source_name", "sportsbook", "home_team", "away_team", "selection")}
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), F.col("l_shipdate").cast("timestamp").alias("market_timestamp"), F.col("l_shipdate").alias("game_datetime"),
        modes.alias("market_type"), F.col("l_discount").alias("line"), F.col("l_quantity").alias("price_american"),
        F.when(F.col("l_linestatus") == "O", "opening").otherwise(F.col("l_linestatus")).alias("snapshot_type"),
        F.current_timestamp().alias("ingestion_ts"), *[v.alias(k) for k, v in fixed.items()],
    )
    return quality.contract(rows, quality.ODDS, "lines")


@query(
    "actuals_attached",
    """
    SELECT p.o_orderkey, p.o_totalprice, ROUND(a.lines_total, 2) AS o_totalprice_actual, a.n AS n_lines
    FROM orders p LEFT JOIN (SELECT l_orderkey, SUM(l_extendedprice) AS lines_total, COUNT(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) a ON p.o_orderkey = a.l_orderkey
    """,
)
def actuals_attached(spark, sf):
    """Predicted order prices beside the outcome of their shipped lines."""
    actual = table(spark, sf, "lineitem").filter("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_extendedprice").alias("o_totalprice"), F.count("*").alias("n_lines")
    )
    out = evaluate.attach_actuals(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), actual, "o_orderkey", ["o_totalprice", "n_lines"])
    return out.withColumn("o_totalprice_actual", F.round("o_totalprice_actual", 2))


@query(
    "split_counts",
    "SELECT CASE WHEN year(o_orderdate) < 1998 THEN 'train' WHEN year(o_orderdate) <= 1999 THEN 'validation' ELSE 'test' END AS cv_split, COUNT(*) AS n FROM orders GROUP BY 1",
)
def split_counts(spark, sf):
    season = F.year("o_orderdate")
    label = F.when(season < 1998, "train").when(season <= 1999, "validation").otherwise("test")
    parts = ml.split(table(spark, sf, "orders").withColumn("cv_split", label))
    whole = parts["train"].unionByName(parts["validation"]).unionByName(parts["test"])
    return ml.split_counts(whole)
