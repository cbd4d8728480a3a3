"""Reports and payloads: quality, coverage, evaluation, dashboards, scenarios, lineage, streams, models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaksafe.operators import dash, evaluate, quality, rolling, scenario
from leaksafe.operators import ml
from leaksafe.plans.queries_time import ORDER, RATING_SQL, open_close, rated_orders, wide_mart
from leaksafe.plans.registry import query, table
from leaksafe.plans.relations import scratch
from leaksafe.session import checkpoint
from leaksafe.sources import payloads, tables
from leaksafe.streaming import snapshots


@query(
    "json_flatten",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_flatten(spark, sf):
    # The flat payload is put into the nested event → markets → outcomes shape first.
    rows = table(spark, sf, "events").select(
        "event_id", "user_id",
        F.concat(F.lit('[{"markets":[{"outcomes":['), F.col("props"), F.lit("]}]}]")).alias("payload"),
    )
    schema = "array<struct<markets array<struct<outcomes array<struct<k int>>>>>>"
    return payloads.flatten_json(rows, "payload", schema, ["", "markets", "outcomes"], {"k": "outcomes.k"})


@query(
    "zip_explode",
    """
    WITH e AS (SELECT event_id, ts, value, CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS n FROM events)
    SELECT event_id, CAST(i AS INTEGER) AS pos, ts + INTERVAL (i) HOUR AS hour, CASE WHEN i < n THEN value * (i + 1) END AS reading
    FROM (SELECT *, UNNEST(range(n + 1)) AS i FROM e) t
    """,
)
def zip_explode(spark, sf):
    # A payload per event: hours 0..k and one reading less than hours, as a feed that is cut short.
    k = F.get_json_object("props", "$.k").cast("int") % 5
    rows = table(spark, sf, "events").withColumns({"steps": F.sequence(F.lit(0), k), "k": k})
    rows = rows.select(
        "event_id",
        F.transform("steps", lambda i: F.timestamp_add("HOUR", i, F.col("ts").cast("timestamp"))).alias("hour"),
        F.transform(F.slice("steps", F.lit(1), F.col("k")), lambda i: F.col("value") * (i + 1)).alias("reading"),
    )
    out = payloads.zip_explode(rows, ["hour", "reading"], ["event_id"], position="pos")
    return out.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(
    "row_hash",
    """
    SELECT o_orderkey, 16 AS hash_length, 'orders' AS source_name, 'parquet' AS source_file_type, '1' AS source_version, o_orderkey % 3 <> 0 AS same_hash FROM orders
    """,
)
def row_hash(spark, sf):
    """Hash values differ between engines. What they must do does not: equal rows equal hashes, a changed column another one."""
    orders = table(spark, sf, "orders")
    out = tables.with_lineage(orders, "orders", "parquet", "1")
    changed = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    again = tables.with_lineage(changed, "orders", "parquet", "2").select("o_orderkey", F.col("row_hash").alias("other"))
    return out.join(again, "o_orderkey").select(
        "o_orderkey", F.length("row_hash").alias("hash_length"), "source_name", "source_file_type", "source_version",
        (F.col("row_hash") == F.col("other")).alias("same_hash"),
    )


@query("row_hash_distinct", "SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS hashes FROM (SELECT DISTINCT * FROM orders UNION ALL SELECT DISTINCT * FROM orders)")
def row_hash_distinct(spark, sf):
    """Every row twice: as many hashes as different rows."""
    orders = table(spark, sf, "orders").distinct()
    out = tables.with_lineage(orders.unionByName(orders), "orders", "parquet")
    return out.agg(F.count("*").alias("rows"), F.count_distinct("row_hash").alias("hashes"))


@query(
    "pending_keys",
    """
    SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM orders l WHERE l.o_custkey = o.o_custkey AND year(l.o_orderdate) = year(o.o_orderdate) AND l.o_orderstatus = 'F')
    """,
)
def pending_keys(spark, sf):
    orders = table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    return tables.pending_keys(orders, orders.filter("o_orderstatus = 'F'"), ["o_custkey", "season"])


# --- quality -----------------------------------------------------------------------------------


@query(
    "quality_report",
    """
    SELECT check_name, CASE WHEN n IS NULL THEN 'ERROR' WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(n AS BIGINT) AS rows FROM (
      SELECT 'unique_orders' AS check_name, (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)) AS n
      UNION ALL SELECT 'unique_lines', (SELECT COUNT(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1))
      UNION ALL SELECT 'not_null_events', (SELECT COUNT(*) FROM events WHERE user_id IS NULL OR ts IS NULL)
      UNION ALL SELECT 'discount_range', (SELECT COUNT(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.08)
      UNION ALL SELECT 'accepted_status', (SELECT COUNT(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
      UNION ALL SELECT 'line_has_order', (SELECT COUNT(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
      UNION ALL SELECT 'order_has_lines', (SELECT COUNT(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE o.o_orderkey = l.l_orderkey))
      UNION ALL SELECT 'no_history_on_first', 0
      UNION ALL SELECT 'shipped_after_order', (SELECT COUNT(*) FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate > l.l_shipdate)
      UNION ALL SELECT 'final_when_returned', (SELECT COUNT(*) FROM lineitem WHERE l_returnflag = 'R' AND NOT COALESCE(l_linestatus = 'F', FALSE))
      UNION ALL SELECT 'columns_present', 1
      UNION ALL SELECT 'first_year_of_customer', (SELECT COUNT(*) FROM (SELECT MIN(year(o_orderdate)) AS y FROM orders GROUP BY o_custkey) WHERE y > 1997)
      UNION ALL SELECT 'labels_cover_documents', (SELECT COUNT(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id))
      UNION ALL SELECT 'broken_check', NULL) t
    """,
)
def quality_report(spark, sf):
    t = lambda name: table(spark, sf, name)
    orders, lines, events_ = t("orders"), t("lineitem"), t("events")
    form = rolling.sequence(orders.withColumn("season", F.year("o_orderdate")), ["o_custkey", "season"], ORDER)
    form = rolling.lagged(form, ["o_custkey", "season"], ORDER, ["o_totalprice"], {"std": None})
    as_line = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    has_lines = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.run(
        spark,
        {
            "unique_orders": lambda: quality.unique(orders, ["o_orderkey"]),
            "unique_lines": lambda: quality.unique(lines, ["l_orderkey", "l_linenumber"]),
            "not_null_events": lambda: quality.not_null(events_, ["user_id", "ts"]),
            "discount_range": lambda: quality.in_range(lines, "l_discount", 0, 0.08),
            "accepted_status": lambda: quality.accepted_values(orders, "o_orderstatus", ["F", "O"]),
            "line_has_order": lambda: quality.relationships(lines, as_line, ["l_orderkey"]),
            "order_has_lines": lambda: quality.relationships(orders, has_lines, ["o_orderkey"]),
            "no_history_on_first": lambda: quality.no_first_row_history(form, "seq", ["o_totalprice_std"]),
            "shipped_after_order": lambda: quality.expression(
                lines.join(as_line, "l_orderkey"), F.col("o_orderdate") <= F.col("l_shipdate")
            ),
            "final_when_returned": lambda: quality.expression(
                lines, F.col("l_linestatus") == "F", where=F.col("l_returnflag") == "R"
            ),
            "columns_present": lambda: quality.has_columns(events_, ["ts", "value", "no_such_column"]),
            "first_year_of_customer": lambda: quality.group_range(
                orders, ["o_custkey"], F.min(F.year("o_orderdate")), high=1997
            ),
            "labels_cover_documents": lambda: quality.relationships(t("documents"), t("labels"), ["doc_id"]),
            "broken_check": lambda: quality.not_null(events_, ["no_such_column"]),
        },
    )


@query(
    "contract_warnings",
    """
    SELECT 'events' AS source, 'event_type' AS column_name, event_type AS value, COUNT(*) AS rows FROM events
    WHERE event_type NOT IN ('purchase', 'view', 'click') GROUP BY 3
    """,
)
def contract_warnings(spark, sf):
    rule = quality.Contract(
        {"event_id": "numeric", "ts": "timestamp", "value": "numeric", "event_type": "string"},
        {"event_type": ("purchase", "view", "click")},
    )
    return quality.contract(table(spark, sf, "events"), rule, "events")


@query(
    "snapshots_before_event",
    """
    SELECT e.event_id, e.user_id, e.ts, p.last_purchase FROM events e
    JOIN (SELECT user_id, MAX(ts) AS last_purchase FROM events WHERE event_type = 'purchase' GROUP BY 1) p USING (user_id)
    WHERE e.ts > p.last_purchase
    """,
)
def snapshots_before_event(spark, sf):
    events_ = table(spark, sf, "events")
    last = events_.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("last_purchase"))
    late = quality.before_event(events_, last, ["user_id"], "ts", "last_purchase")
    return late.select("event_id", "user_id", "ts", "last_purchase")


@query(
    "coverage_by_period",
    """
    SELECT CAST(ts AS DATE) AS day, COUNT(DISTINCT user_id) AS total_keys,
      COUNT(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS buyers, COUNT(DISTINCT user_id) FILTER (WHERE value > 20) AS big
    FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 5
    """,
)
def coverage_by_period(spark, sf):
    # The report shows the latest five periods.
    out = quality.coverage(
        table(spark, sf, "events").withColumn("day", F.to_date("ts")), ["day"], "user_id",
        {"buyers": F.col("event_type") == "purchase", "big": F.col("value") > 20},
    )
    return out.orderBy(F.col("day").desc()).limit(5)


# --- evaluation --------------------------------------------------------------------------------

PREDICTED_SQL = """
    p AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS season, ln(o_totalprice) AS actual,
            AVG(ln(o_totalprice)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pred
          FROM orders)
"""
REGRESSION_SQL = """
    COUNT(actual - pred) AS n, ROUND(sqrt(AVG((actual - pred) * (actual - pred))), 6) AS rmse, ROUND(AVG(abs(actual - pred)), 6) AS mae,
    ROUND(AVG(actual - pred), 6) AS bias, ROUND(1 - SUM((actual - pred) * (actual - pred)) / (COUNT(actual) * var_pop(actual)), 6) AS r2
"""


def predicted(spark, sf) -> DataFrame:
    """Orders with the customer's lagged mean as a prediction."""
    orders = table(spark, sf, "orders").withColumns({"season": F.year("o_orderdate"), "actual": F.log("o_totalprice")})
    out = rolling.lagged(orders, ["o_custkey"], ORDER, ["actual"], {"std": None}, count=None)
    return out.withColumnRenamed("actual_std", "pred")


def _rounded(df, digits=6):
    keep = {f.name for f in df.schema.fields if f.dataType.simpleString() == "double"}
    return df.withColumns({c: F.round(c, digits) for c in keep})


@query(
    "regression_metrics",
    f"WITH {PREDICTED_SQL} SELECT {REGRESSION_SQL}, ROUND(stddev_samp(pred), 6) AS sd_pred, ROUND(stddev_samp(actual), 6) AS sd_actual FROM p",
)
def regression_metrics(spark, sf):
    return _rounded(evaluate.regression(predicted(spark, sf), "actual", "pred"))


@query(
    "residual_calibration",
    f"""
    WITH {PREDICTED_SQL}
    SELECT ROUND(stddev_samp(actual - pred), 6) AS price_sd, ROUND(AVG(abs(actual - pred)), 6) AS price_mae, ROUND(AVG(actual - pred), 6) AS price_bias,
      COUNT(actual - pred) AS price_n FROM p
    """,
)
def residual_calibration(spark, sf):
    return _rounded(evaluate.residuals(predicted(spark, sf), {"price": ("actual", "pred")}))


@query(
    "segment_metrics",
    f"""
    WITH {PREDICTED_SQL},
    s AS (SELECT 'overall' AS segment, 'overall' AS label, actual, pred FROM p UNION ALL SELECT 'priority', o_orderpriority, actual, pred FROM p
          UNION ALL SELECT 'status', o_orderstatus, actual, pred FROM p
          UNION ALL SELECT 'split', CASE WHEN season < 1998 THEN 'train' WHEN season <= 1999 THEN 'validation' ELSE 'test' END, actual, pred FROM p
          UNION ALL SELECT 'weekend', CASE WHEN o_orderkey % 7 < 2 THEN 'weekend' ELSE 'weekday' END, actual, pred FROM p)
    SELECT segment, label, {REGRESSION_SQL} FROM s GROUP BY 1, 2
    """,
)
def segment_metrics(spark, sf):
    from leaksafe.operators.marts import temporal_split

    out = evaluate.by_segment(
        predicted(spark, sf), "actual", "pred",
        {
            "priority": "o_orderpriority", "status": "o_orderstatus", "split": temporal_split("season", 1998, 1999),
            "weekend": F.when(F.col("o_orderkey") % 7 < 2, "weekend").otherwise("weekday"),
        },
    )
    return _rounded(out.drop("sd_pred", "sd_actual"))


@query(
    "season_metrics",
    f"""
    WITH {PREDICTED_SQL}
    SELECT season, {REGRESSION_SQL}, ROUND(AVG(CASE WHEN (actual > 12.3::DOUBLE) = (pred > 12.3::DOUBLE) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS agreement_rate
    FROM p WHERE pred IS NOT NULL GROUP BY season
    """,
)
def season_metrics(spark, sf):
    rows = predicted(spark, sf).withColumn("line", F.lit(-12.3))
    return _rounded(evaluate.by_period(rows, "actual", "pred", "season", "line"))


PROB_SQL = """
    pr AS (SELECT e.o_orderkey, e.outcome, g.o_orderpriority, g.o_totalprice / 1000 AS price, 1 / (1 + exp(-(e.pre - 1500) / 10.0::DOUBLE + (e.o_orderkey % 13 - 6) / 20.0::DOUBLE)) AS prob
           FROM elo e JOIN gs g USING (o_orderkey))
"""


def rated_prob(spark, sf) -> DataFrame:
    """Orders with an outcome and a probability from the rating before the order."""
    spread = (F.col("o_orderkey") % 13 - 6) / 20.0
    prob = 1 / (1 + F.exp(-(F.col("rating_pre") - 1500) / 10.0 + spread))
    return rated_orders(spark, sf).withColumns({"prob": prob, "price": F.col("o_totalprice") / 1000})


@query(
    "classification_metrics",
    f"""
    WITH RECURSIVE {RATING_SQL}, {PROB_SQL},
    c AS (SELECT *, CASE WHEN prob IS NULL THEN NULL ELSE LEAST(GREATEST(prob, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) END AS q FROM pr)
    SELECT COUNT(outcome) AS n, ROUND(-AVG(outcome * ln(q) + (1 - outcome) * ln(1 - q)), 6) AS logloss, ROUND(AVG((outcome - prob) * (outcome - prob)), 6) AS brier_score,
      ROUND(AVG(CASE WHEN outcome IS NOT NULL THEN CASE WHEN CAST(prob >= 0.5 AS INTEGER) = outcome THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END), 6) AS accuracy,
      ROUND(GREATEST(AVG(outcome), 1 - AVG(outcome)), 6) AS baseline_acc,
      ROUND(AVG(CASE WHEN outcome IS NOT NULL THEN CASE WHEN CAST(prob >= 0.5 AS INTEGER) = outcome THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END) - GREATEST(AVG(outcome), 1 - AVG(outcome)), 6) AS accuracy_lift,
      ROUND(AVG(prob), 6) AS mean_pred_prob, ROUND(AVG(outcome), 6) AS actual_win_rate
    FROM c
    """,
)
def classification_metrics(spark, sf):
    return _rounded(evaluate.classification(rated_prob(spark, sf), "outcome", "prob"))


CALIBRATION_SQL = f"""
    {RATING_SQL}, {PROB_SQL},
    cal AS (SELECT CAST(GREATEST(1, ceil(prob * 10)) AS INTEGER) AS bin, COUNT(*) AS n, AVG(prob) AS mean_pred, AVG(outcome) AS actual_rate
            FROM pr WHERE outcome IS NOT NULL AND prob IS NOT NULL GROUP BY 1)
"""


@query(
    "calibration_bins",
    f"""
    WITH RECURSIVE {CALIBRATION_SQL}
    SELECT bin, n, ROUND(mean_pred, 6) AS mean_pred, ROUND(actual_rate, 6) AS actual_rate, ROUND(actual_rate - mean_pred, 6) AS calibration_error,
      CAST(CAST(ROUND(mean_pred * 100) AS INTEGER) AS VARCHAR) || '%' AS bin_label FROM cal
    """,
)
def calibration_bins(spark, sf):
    return _rounded(evaluate.calibration(rated_prob(spark, sf), "outcome", "prob"))


@query(
    "calibration_ece",
    f"WITH RECURSIVE {CALIBRATION_SQL} SELECT ROUND(SUM(n * abs(actual_rate - mean_pred)) / SUM(n), 6) AS ece FROM cal",
)
def calibration_ece(spark, sf):
    return _rounded(evaluate.expected_calibration_error(evaluate.calibration(rated_prob(spark, sf), "outcome", "prob")))


@query(
    "bet_ledger",
    f"""
    WITH RECURSIVE {RATING_SQL}, {PROB_SQL},
    b AS (SELECT o_orderpriority, price, CASE WHEN prob > 0.5::DOUBLE + 0.04::DOUBLE / 2 THEN 'a' WHEN 1 - prob > 0.5::DOUBLE + 0.04::DOUBLE / 2 THEN 'b' END AS side FROM pr),
    w AS (SELECT *, CASE WHEN side = 'a' AND price > 250 OR side = 'b' AND price < 250 THEN 1 WHEN side IS NOT NULL AND price != 250 THEN 0 END AS won FROM b)
    SELECT o_orderpriority, COUNT(*) AS n_games, COUNT(won) AS n_bets, CAST(COALESCE(SUM(won), 0) AS BIGINT) AS n_won, CAST(COUNT(won) - COALESCE(SUM(won), 0) AS BIGINT) AS n_lost,
      CAST(SUM(CASE WHEN price = 250 THEN 1 ELSE 0 END) AS BIGINT) AS n_push, COUNT(*) - COUNT(side) AS n_no_bet, ROUND(AVG(CAST(won AS DOUBLE)), 6) AS win_pct,
      ROUND(SUM(won) * 100.0::DOUBLE - (COUNT(won) - SUM(won)) * 110.0::DOUBLE, 6) AS profit,
      ROUND((SUM(won) * 100.0::DOUBLE - (COUNT(won) - SUM(won)) * 110.0::DOUBLE) / (COUNT(won) * 110.0::DOUBLE), 6) AS roi, ROUND(110 / 210.0::DOUBLE, 6) AS breakeven_wp
    FROM w GROUP BY 1
    """,
)
def bet_ledger(spark, sf):
    rows = rated_prob(spark, sf).withColumn("prob_b", 1 - F.col("prob"))
    return _rounded(evaluate.ledger(rows, "price", F.lit(250.0), "prob", "prob_b", 0.04, by=["o_orderpriority"]))


LINE_SQL = """
    oc AS (SELECT user_id, event_type, AVG(ln(1 + value)) AS pred, arg_min(value, ts) - 10 AS o, arg_max(value, ts) - 10 AS c FROM events GROUP BY 1, 2),
    lv AS (SELECT *, abs(o - c) AS size, CASE WHEN (pred > -o) = (c < o) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS agree FROM oc)
"""


def _lines(spark, sf):
    pred = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.avg(F.log(1 + F.col("value"))).alias("pred"))
    return open_close(spark, sf).join(pred, ["user_id", "event_type"])


@query(
    "line_value",
    f"""
    WITH {LINE_SQL} SELECT COUNT(*) AS n_games, ROUND(AVG(agree), 6) AS pct_agree_with_market, ROUND(AVG(o - c), 6) AS mean_line_movement,
      ROUND(AVG(size), 6) AS mean_abs_movement, ROUND(AVG(pred + o), 6) AS mean_model_vs_opening FROM lv
    """,
)
def line_value(spark, sf):
    return _rounded(evaluate.line_value(_lines(spark, sf), "pred", "open_line", "close_line"))


@query(
    "line_value_quartiles",
    f"""
    WITH {LINE_SQL}, t AS (SELECT *, ntile(4) OVER (ORDER BY round(size, 6), user_id, event_type) AS tile FROM lv)
    SELECT CAST(tile AS INTEGER) AS movement_tile, COUNT(*) AS n, ROUND(AVG(agree), 6) AS pct_agree, ROUND(AVG(size), 4) AS mean_movement FROM t GROUP BY 1
    """,
)
def line_value_quartiles(spark, sf):
    # Values have two decimals; rounding their difference makes equal moves equal.
    lines = _lines(spark, sf).withColumn("close_line", F.col("open_line") - F.round(F.col("open_line") - F.col("close_line"), 6))
    lines = lines.withColumns({"open_line": F.round("open_line", 6), "close_line": F.round("close_line", 6)})
    out = evaluate.line_value_tiles(lines, "pred", "open_line", "close_line", tie=["user_id", "event_type"])
    return out.withColumns({"pct_agree": F.round("pct_agree", 6), "mean_movement": F.round("mean_movement", 4)})


# --- dashboards --------------------------------------------------------------------------------


def _facts(spark, sf):
    return table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("season"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("points"),
    )


@query(
    "entity_list",
    """
    SELECT o_custkey, o_orderpriority, MAX(CAST(year(o_orderdate) AS INTEGER)) AS latest_season, MIN(CAST(year(o_orderdate) AS INTEGER)) AS first_season,
      MAX(o_orderstatus) AS latest_o_orderstatus, ROUND(SUM(o_totalprice / 1000), 6) AS career_points, ANY_VALUE(c_name) AS c_name, ANY_VALUE(c_acctbal) AS c_acctbal
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2 HAVING SUM(o_totalprice / 1000) > 500
    """,
)
def entity_list(spark, sf):
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    out = dash.entities(
        _facts(spark, sf), customers, "o_custkey", ["o_orderpriority"], "season", "o_orderstatus", "points",
        attributes=["c_name", "c_acctbal"], min_points=500, group=("o_orderpriority", ["1-URGENT", "2-HIGH"]),
    )
    return out.withColumn("career_points", F.round("career_points", 6))


@query(
    "career_rollup",
    """
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus, COUNT(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS games, COUNT(*) AS n_orders,
      ROUND(SUM(o_totalprice / 1000), 6) AS points, ROUND(SUM(ln(o_totalprice)) / COUNT(DISTINCT strftime(o_orderdate, '%Y%m%d')), 6) AS log_per_game,
      ROUND(SUM(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) * 100.0::DOUBLE / COUNT(*), 4) AS urgent_pct
    FROM orders GROUP BY 1, 2, 3
    """,
)
def career_rollup(spark, sf):
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT")
    return dash.career(
        _facts(spark, sf), ["o_custkey", "season", "o_orderstatus"], "day",
        {
            "n_orders": F.count(F.lit(1)),
            "points": F.round(F.sum("points"), 6),
            "log_per_game": dash.share(F.sum(F.log(F.col("points") * 1000)), F.count_distinct("day"), 6),
            "urgent_pct": dash.share(urgent, F.count(F.lit(1)), 4, 100.0),
        },
    )


@query(
    "career_summary",
    """
    WITH c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, COUNT(DISTINCT strftime(o_orderdate, '%Y%m%d')) AS games, COUNT(*) AS n_orders, SUM(o_totalprice / 1000) AS points
               FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT CAST(SUM(games) AS BIGINT) AS games, CAST(SUM(n_orders) AS BIGINT) AS n_orders, ROUND(SUM(points), 2) AS points, ROUND(SUM(points) / SUM(games), 6) AS points_per_game FROM c
    """,
)
def career_summary(spark, sf):
    facts = _facts(spark, sf)
    regular = facts.filter("o_orderstatus = 'F'")
    career = dash.career(regular, ["o_custkey", "season"], "day", {"n_orders": F.count(F.lit(1)), "points": F.sum("points")})
    out = dash.career_summary(career, ["n_orders"], "points")
    return out.withColumns({"points": F.round("points", 2), "points_per_game": F.round("points_per_game", 6)})


@query(
    "season_summary",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS season, COUNT(*) AS n, ROUND(SUM(o_totalprice / 1000), 2) AS total_points, ROUND(AVG(o_totalprice / 1000), 6) AS avg_points,
      MAX(o_totalprice / 1000) AS max_points FROM orders GROUP BY 1
    """,
)
def season_summary(spark, sf):
    out = dash.season_summary(_facts(spark, sf), "points", ["season"])
    return out.withColumns({"total_points": F.round("total_points", 2), "avg_points": F.round("avg_points", 6)})


@query(
    "entity_periods",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders",
)
def entity_periods(spark, sf):
    return dash.periods(_facts(spark, sf), "season")


@query(
    "entity_log",
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, ROUND(o_totalprice / 1000, 1) AS points FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE lower(c_name) LIKE '%05%' AND lower(c_name) LIKE '%r%') AND o_orderstatus = 'F'
    """,
)
def entity_log(spark, sf):
    people = dash.search(dash.search(table(spark, sf, "customer"), "c_name", "05"), "c_name", "R").select(F.col("c_custkey").alias("o_custkey"))
    rows = table(spark, sf, "orders").join(people, "o_custkey", "left_semi")
    where = F.col("o_orderstatus") == "F"
    return dash.log(
        rows, where, ["day", "o_orderkey"],
        {"o_orderkey": "o_orderkey", "day": F.to_date("o_orderdate"), "o_orderstatus": "o_orderstatus", "points": F.round(F.col("o_totalprice") / 1000, 1)},
    )


@query(
    "tracking_average",
    """
    SELECT COUNT(DISTINCT CAST(ts AS DATE)) AS weeks, CAST(SUM(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS k, ROUND(AVG(value), 6) AS avg_value
    FROM events WHERE event_type = 'view'
    """,
)
def tracking_average(spark, sf):
    rows = table(spark, sf, "events").withColumns(
        {"day": F.to_date("ts"), "k": F.get_json_object("props", "$.k").cast("int")}
    )
    return dash.season_average(rows, F.col("event_type") == "view", "day", ["k"], {"avg_value": ("value", 6)})


# --- scenarios ---------------------------------------------------------------------------------

N_DRAWS = 100


def _mix_sql(source: str, name: str, columns: dict[str, str], stage: int) -> tuple[str, int]:
    """Stages of the integer mixer as CTEs; returns the SQL and the last stage number."""
    sql = ""
    for multiplier in scenario.MULTIPLIERS:
        for step in ("xor(({c}), (({c}) >> 16))", "((({c}) * " + str(multiplier) + ") & " + str(scenario.MASK) + ")"):
            cols = ", ".join(f"{step.format(c=c)} AS {c}" for c in columns)
            sql += f", {name}{stage} AS (SELECT * REPLACE ({cols}) FROM {source})"
            source, stage = f"{name}{stage}", stage + 1
    cols = ", ".join(f"xor(({c}), (({c}) >> 15)) AS {c}" for c in columns)
    sql += f", {name}{stage} AS (SELECT * REPLACE ({cols}) FROM {source})"
    return sql, stage


def _scenario_sql() -> str:
    mask, us = scenario.MASK, [f"u{i}" for i in range(4)]
    sql = (
        "WITH base AS (SELECT o_orderkey AS id, o_totalprice / 20000 - 10 AS mm, 40 + (o_orderkey % 21)::DOUBLE / 2 AS mt, -3.5::DOUBLE AS sp, "
        f"45.5::DOUBLE AS tl, ((o_orderkey >> 31) + 0) & {mask} AS hi FROM orders)"
    )
    part, last = _mix_sql("base", "a", {"hi": ""}, 0)
    sql += part + f", s AS (SELECT *, xor(id & {mask}, hi) AS start_ FROM a{last})"
    part, last = _mix_sql("s", "b", {"start_": ""}, 0)
    streams = ", ".join(f"xor(start_, (counter + {s}) & {mask}) AS u{i}" for i, s in enumerate(scenario.STREAMS))
    sql += part + (
        f", d AS (SELECT *, (draw * {scenario.DRAW_STEP}) & {mask} AS counter FROM (SELECT *, UNNEST(range({N_DRAWS})) AS draw FROM b{last}))"
        f", st AS (SELECT *, {streams} FROM d)"
    )
    part, last = _mix_sql("st", "c", dict.fromkeys(us, ""), 0)
    sql += part
    part, end = _mix_sql(f"c{last}", "e", dict.fromkeys(us, ""), 0)
    sql += part
    to_unit = ", ".join(f"(u{i} + 0.5::DOUBLE) / 2147483648.0::DOUBLE AS v{i}" for i in range(4))
    sql += f"""
    , n AS (SELECT *, {to_unit} FROM e{end})
    , z AS (SELECT *, mm + 13.5::DOUBLE * sqrt(-2 * ln(v0)) * cos(2 * pi() * v1) AS m, mt + 11.0::DOUBLE * sqrt(-2 * ln(v2)) * cos(2 * pi() * v3) AS t FROM n)
    , g AS (SELECT *, GREATEST((t + m) / 2, 0) AS h, GREATEST((t - m) / 2, 0) AS a FROM z)
    , f AS (SELECT *, h - a AS margin, h + a AS points FROM g)
    , r AS (SELECT id AS o_orderkey, AVG((margin > 0)::INTEGER) AS p_home_win, AVG((margin < 0)::INTEGER) AS p_away_win,
      AVG((margin > -sp)::INTEGER) AS p_home_cover, AVG((margin < -sp)::INTEGER) AS p_away_cover, AVG((points > tl)::INTEGER) AS p_over, AVG((points < tl)::INTEGER) AS p_under,
      quantile_cont(margin, 0.1) AS margin_p10, quantile_cont(margin, 0.25) AS margin_p25, quantile_cont(margin, 0.5) AS margin_p50, quantile_cont(margin, 0.75) AS margin_p75,
      quantile_cont(margin, 0.9) AS margin_p90, stddev_samp(margin) AS margin_sim_sd, quantile_cont(points, 0.1) AS total_p10, quantile_cont(points, 0.5) AS total_p50,
      quantile_cont(points, 0.9) AS total_p90 FROM f GROUP BY id)
    SELECT o_orderkey, ROUND(p_home_win, 4) AS p_home_win, ROUND(p_away_win, 4) AS p_away_win, ROUND(p_home_cover, 4) AS p_home_cover, ROUND(p_away_cover, 4) AS p_away_cover,
      ROUND(p_over, 4) AS p_over, ROUND(p_under, 4) AS p_under, ROUND(margin_p10, 4) AS margin_p10, ROUND(margin_p25, 4) AS margin_p25, ROUND(margin_p50, 4) AS margin_p50,
      ROUND(margin_p75, 4) AS margin_p75, ROUND(margin_p90, 4) AS margin_p90, ROUND(margin_sim_sd, 4) AS margin_sim_sd, ROUND(total_p10, 4) AS total_p10,
      ROUND(total_p50, 4) AS total_p50, ROUND(total_p90, 4) AS total_p90, ROUND(p_home_win - 1.96::DOUBLE * sqrt(p_home_win * (1 - p_home_win) / {N_DRAWS}), 4) AS p_home_win_ci_lo,
      ROUND(p_home_win + 1.96::DOUBLE * sqrt(p_home_win * (1 - p_home_win) / {N_DRAWS}), 4) AS p_home_win_ci_hi, {N_DRAWS} AS n_sims,
      ROUND(p_home_cover * (10000 / 110.0::DOUBLE) - (1 - p_home_cover) * 100, 2) AS ev_spread_home,
      ROUND(p_over * (10000 / 110.0::DOUBLE) - (1 - p_over) * 100, 2) AS ev_over
    FROM r
    """
    return sql


@query("scenario_summary", _scenario_sql())
def scenario_summary(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_totalprice") / 20000 - 10).alias("mu_margin"), (40 + (F.col("o_orderkey") % 21) / 2).alias("mu_total")
    )
    out = scenario.summarise(rows, "o_orderkey", "mu_margin", "mu_total", F.lit(-3.5), F.lit(45.5), n=N_DRAWS)
    out = scenario.with_ev(out)
    names = [c for c in out.columns if c.startswith(("p_", "margin_", "total_"))]
    return out.select("o_orderkey", *[F.round(c, 4).alias(c) for c in names], "n_sims", "ev_spread_home", "ev_over")


# --- streams -----------------------------------------------------------------------------------


POLLS = 4


def _stream(spark, sf):
    """The events as a stream of polls, one a trigger: stretches of time, the newest first, and a poll of repeats at last.

    A poll comes a day after the one before. Each is as many files as Spark has tasks for it.
    """
    events = table(spark, sf, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * k / POLLS for k in range(1, POLLS)]
    files = spark.sparkContext.defaultParallelism
    folder = scratch(spark, "events")
    polls = []
    for low, high in reversed(list(zip([None, *cuts], [*cuts, None], strict=True))):
        part = events if low is None else events.filter(F.col("ts") >= F.lit(low))
        polls.append(part if high is None else part.filter(F.col("ts") < F.lit(high)))
    polls.append(events.filter(F.col("event_id") % 10 == 3))
    for k, poll in enumerate(polls):
        poll = poll.withColumn("polled", F.lit(last).cast("timestamp") + F.expr(f"INTERVAL {k} DAYS"))
        poll.repartition(files, "event_id").write.mode("append").parquet(folder)
    stream = snapshots.read_snapshots(spark, folder, poll.schema, "ts", files_per_trigger=files)
    return stream.withColumn("book", F.get_json_object("props", "$.k").cast("int") % 5)


@query("stream_dedup", "SELECT user_id, event_type, ts, 1 AS rows, MIN(value) AS value FROM events GROUP BY 1, 2, 3")
def stream_dedup(spark, sf):
    out = scratch(spark, "dedup")
    stream = _stream(spark, sf)
    done = snapshots.drain(
        snapshots.append_new(stream, ["user_id", "event_type"], "ts", f"{out}/table", f"{out}/checkpoint", delay="1 day", arrived="polled"),
        lambda: snapshots.read_appended(spark, f"{out}/table", stream.schema),
    )
    return done.groupBy("user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts")).agg(
        F.count(F.lit(1)).cast("int").alias("rows"), F.min("value").alias("value")
    )


@query(
    "stream_consensus",
    """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, COUNT(DISTINCT CAST(json_extract(props, '$.k') AS INTEGER) % 5) AS book_count,
      ROUND(AVG(value), 6) AS consensus_line, MIN(value) AS line_min, MAX(value) AS line_max, ROUND(stddev_pop(value), 6) AS line_stddev
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 3) GROUP BY 1, 2
    """,
)
def stream_consensus(spark, sf):
    out = scratch(spark, "consensus")
    keys = ["event_type"]
    parts = snapshots.consensus_parts(_stream(spark, sf), keys, "ts", "1 day", "book", "value", delay="1 day", arrived="polled")
    done = snapshots.drain(
        snapshots.consensus_table(parts, keys, f"{out}/table", f"{out}/checkpoint"),
        lambda: snapshots.read_consensus(spark, parts, keys, f"{out}/table"),
    )
    return done.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "book_count",
        F.round("consensus_line", 6).alias("consensus_line"), "line_min", "line_max", F.round("line_stddev", 6).alias("line_stddev"),
    )


@query(
    "stream_latest",
    """
    SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events
      WHERE ts < TIMESTAMP '2024-01-25') WHERE rn = 1
    """,
)
def stream_latest(spark, sf):
    out = scratch(spark, "latest")
    stream = _stream(spark, sf).withColumn("cutoff", F.lit("2024-01-25").cast("timestamp"))
    keys, tie = ["user_id", "event_type"], ["event_id"]
    done = snapshots.drain(
        snapshots.latest_per_key(stream, keys, "ts", f"{out}/rows", f"{out}/checkpoint", cutoff="cutoff", tie=tie),
        lambda: snapshots.read_latest(spark, f"{out}/rows", stream.schema, keys, "ts", tie),
    )
    return done.select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "value")


# --- models ------------------------------------------------------------------------------------


@query("gbt_scores")
def gbt_scores(spark, sf):
    spec = ml.FeatureSpec(
        identifiers=("o_orderkey", "season", "split"),
        targets=("o_totalprice", "outcome"),
        features=("price_std", "rate_std", "games_played", "rating_pre", "n_lines", "season"),
    )
    # Every model reads the mart many times: it is worked out once, and only as wide as the models need it.
    wanted = dict.fromkeys([*spec.identifiers, *spec.targets, *spec.features])
    mart = checkpoint(wide_mart(spark, sf).select(*wanted))
    frames = ml.split(mart, "split")
    models = ml.train(
        frames["train"], frames["validation"], spec,
        {"price": ("o_totalprice", "regression"), "win": ("outcome", "classification")},
    )
    scored = ml.score(frames["test"], models)
    return scored.select("o_orderkey", "season", F.round("pred_price", 2).alias("pred_price"), F.round("pred_win", 4).alias("pred_win"))
