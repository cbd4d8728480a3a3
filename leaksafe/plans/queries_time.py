"""Queries along time: lagged form, schedules, ratings, as-of joins, horizons, consensus."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaksafe.functions import odds
from leaksafe.operators import asof, consensus, events, facts, horizons, joins, marts, rolling, schedule
from leaksafe.operators.events import Agg
from leaksafe.operators.ratings import affine_rating
from leaksafe.operators.windows import profile
from leaksafe.plans.registry import query, table

ORDER = ["o_orderdate", "o_orderkey"]


def order_form(spark, sf):
    """Orders with the rollup of their lines: the entity's events of the running examples."""
    lines = events.rollup(
        table(spark, sf, "lineitem"), ["l_orderkey"],
        {"n_lines": Agg("count"), "quantity": Agg("sum", "l_quantity"), "return_rate": Agg("rate", F.col("l_returnflag") == "R")},
    )
    orders = table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").drop("l_orderkey")


ORDER_FORM_SQL = """
    lines AS (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS quantity,
                     AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS return_rate
              FROM lineitem GROUP BY l_orderkey),
    f AS (SELECT o.*, CAST(year(o.o_orderdate) AS INTEGER) AS season, l.n_lines, l.quantity, l.return_rate
          FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey)
"""


@query(
    "lagged_form",
    f"""
    WITH {ORDER_FORM_SQL}
    SELECT o_orderkey, o_custkey, season,
      CASE WHEN season < 1998 THEN 'train' WHEN season <= 1999 THEN 'validation' ELSE 'test' END AS split,
      ROW_NUMBER() OVER k AS game_num,
      ROUND(AVG(o_totalprice) OVER s, 4) AS o_totalprice_std, ROUND(AVG(o_totalprice) OVER l5, 4) AS o_totalprice_l5,
      ROUND(AVG(o_totalprice) OVER l3, 4) AS o_totalprice_l3,
      ROUND(AVG(quantity) OVER s, 4) AS quantity_std, ROUND(AVG(quantity) OVER l5, 4) AS quantity_l5, ROUND(AVG(quantity) OVER l3, 4) AS quantity_l3,
      ROUND(AVG(return_rate) OVER s, 4) AS return_rate_std, ROUND(AVG(return_rate) OVER l5, 4) AS return_rate_l5,
      ROUND(AVG(return_rate) OVER l3, 4) AS return_rate_l3, COUNT(*) OVER s AS games_played,
      CAST(SUM(n_lines) OVER l5 AS BIGINT) AS n_lines_l5_sum
    FROM f
    WINDOW k AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey),
      s AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      l5 AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
      l3 AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
    """,
)
def lagged_form(spark, sf):
    keys, cols = ["o_custkey", "season"], ["o_totalprice", "quantity", "return_rate"]
    base = order_form(spark, sf)
    # The rollup joins one row per order, so the orders alone tell which keys are hot.
    hot = profile(table(spark, sf, "orders").withColumn("season", F.year("o_orderdate")), keys, ORDER)
    out = rolling.lagged(base, keys, ORDER, cols, {"std": None, "l5": 5, "l3": 3}, hot=hot)
    out = rolling.lagged(out, keys, ORDER, ["n_lines"], {"l5": 5}, aggs=("sum",), count=None, hot=hot)
    out = rolling.sequence(out, keys, ORDER, "game_num", hot=hot)
    rounded = [F.round(f"{c}_{w}", 4).alias(f"{c}_{w}") for c in cols for w in ("std", "l5", "l3")]
    return out.select(
        "o_orderkey", "o_custkey", "season", marts.temporal_split("season", 1998, 1999).alias("split"),
        "game_num", *rounded, "games_played", "n_lines_l5_sum",
    )


@query(
    "prior_period_join",
    """
    WITH y AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, COUNT(*) AS n_orders, AVG(o_totalprice) AS avg_price FROM orders GROUP BY 1, 2)
    SELECT c.o_custkey, c.season, c.n_orders, ROUND(c.avg_price, 4) AS avg_price, p.n_orders AS prior_n_orders, ROUND(p.avg_price, 4) AS prior_avg_price
    FROM y c LEFT JOIN y p ON c.o_custkey = p.o_custkey AND c.season = p.season + 1
    """,
)
def prior_period_join(spark, sf):
    orders = table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    years = events.rollup(orders, ["o_custkey", "season"], {"n_orders": Agg("count"), "avg_price": Agg("avg", "o_totalprice")})
    prior = years.withColumnsRenamed({"n_orders": "prior_n_orders", "avg_price": "prior_avg_price"})
    out = joins.prior_period(years, prior, ["o_custkey"], "season")
    return out.withColumns({c: F.round(c, 4) for c in ("avg_price", "prior_avg_price")})


@query(
    "blend_prior",
    """
    WITH f AS (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS season, ln(o_totalprice) AS log_price FROM orders),
    cur AS (SELECT o_orderkey, o_custkey, season,
              AVG(log_price) OVER w AS std, COUNT(*) OVER w AS n FROM f
              WINDOW w AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    p AS (SELECT o_custkey, season, AVG(log_price) AS prior FROM f GROUP BY 1, 2)
    SELECT c.o_orderkey, c.season, c.n AS games_played,
      ROUND(CASE WHEN c.n >= 3 THEN 0.7::DOUBLE * COALESCE(c.std, 0) + 0.3::DOUBLE * COALESCE(p.prior, 0) ELSE COALESCE(p.prior, 0) END, 4) AS blended
    FROM cur c LEFT JOIN p ON c.o_custkey = p.o_custkey AND c.season = p.season + 1
    """,
)
def blend_prior(spark, sf):
    orders = table(spark, sf, "orders").withColumns({"season": F.year("o_orderdate"), "log_price": F.log("o_totalprice")})
    form = rolling.lagged(orders, ["o_custkey", "season"], ORDER, ["log_price"], {"std": None})
    prior = rolling.prior_period_avg(orders, ["o_custkey"], "season", {"prior_price": "log_price"})
    out = form.join(prior, ["o_custkey", "season"], "left")
    blended = rolling.blend_prior("log_price_std", "prior_price", "games_played")
    return out.select("o_orderkey", "season", "games_played", F.round(blended, 4).alias("blended"))


@query(
    "schedule_gaps",
    """
    WITH g AS (SELECT o_orderkey, o_orderdate, LAG(o_orderdate) OVER w AS prev, LEAD(o_orderdate) OVER w AS nxt FROM orders
               WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    d AS (SELECT *, CAST(date_diff('day', prev, o_orderdate) AS INTEGER) AS since FROM g)
    SELECT o_orderkey, since AS days_since_last, CASE WHEN prev IS NULL THEN 1 ELSE 0 END AS opener_flag,
      CASE WHEN since <= 6 THEN 1 ELSE 0 END AS short_gap_flag, CASE WHEN since >= 10 THEN 1 ELSE 0 END AS long_gap_flag,
      CAST(date_diff('day', o_orderdate, nxt) AS INTEGER) AS days_until_next
    FROM d
    """,
)
def schedule_gaps(spark, sf):
    out = schedule.gaps(table(spark, sf, "orders"), ["o_custkey"], ORDER, "o_orderdate")
    return out.select("o_orderkey", "days_since_last", "opener_flag", "short_gap_flag", "long_gap_flag", "days_until_next")


@query(
    "recent_counts",
    """
    SELECT o_orderkey, CAST(o_orderkey % 2 AS INTEGER) AS road_flag,
      CAST(SUM(CAST(o_orderkey % 2 AS INTEGER)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS road_last4
    FROM orders
    """,
)
def recent_counts(spark, sf):
    orders = table(spark, sf, "orders").withColumn("road_flag", (F.col("o_orderkey") % 2).cast("int"))
    out = schedule.recent_counts(orders, ["o_custkey"], ORDER, "road_flag", out="road_last4")
    return out.select("o_orderkey", "road_flag", "road_last4")


@query(
    "true_streak",
    """
    WITH n AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderkey % 2 AS f, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders),
    g AS (SELECT *, SUM(CASE WHEN f = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS island FROM n)
    SELECT o_orderkey, CAST(COALESCE(SUM(f) OVER (PARTITION BY o_custkey ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        - COALESCE(MAX(CASE WHEN f = 0 THEN total END) OVER (PARTITION BY o_custkey ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS streak
    FROM (SELECT *, SUM(f) OVER (PARTITION BY o_custkey ORDER BY rn) AS total FROM g) t
    """,
)
def true_streak(spark, sf):
    orders = table(spark, sf, "orders").withColumn("road_flag", (F.col("o_orderkey") % 2).cast("int"))
    return schedule.streak(orders, ["o_custkey"], ORDER, "road_flag").select("o_orderkey", "streak")


def _sides():
    outcome = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    return {"outcome": outcome, "home": (F.col("o_orderkey") % 2).cast("int")}


RATING_SQL = """
    gs AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS season,
             CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome, o_orderkey % 2 AS home,
             ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders),
    elo AS (
      SELECT o_orderkey, o_custkey, season, outcome, seq, 1500.0::DOUBLE AS pre,
        1500.0::DOUBLE + CASE WHEN outcome IS NULL THEN 0.0::DOUBLE ELSE 20.0::DOUBLE * (outcome - 1.0::DOUBLE / (1.0::DOUBLE + pow(10.0::DOUBLE, -65.0::DOUBLE / 400.0::DOUBLE))) END AS post
      FROM gs WHERE seq = 1
      UNION ALL
      SELECT g.o_orderkey, g.o_custkey, g.season, g.outcome, g.seq,
        CASE WHEN g.season > e.season THEN e.post + 0.33::DOUBLE * (1500.0::DOUBLE - e.post) ELSE e.post END,
        CASE WHEN g.outcome IS NULL THEN e.post
             ELSE (CASE WHEN g.season > e.season THEN e.post + 0.33::DOUBLE * (1500.0::DOUBLE - e.post) ELSE e.post END)
               + 20.0::DOUBLE * (g.outcome - 1.0::DOUBLE / (1.0::DOUBLE + pow(10.0::DOUBLE, (CASE WHEN g.home = 1 THEN -65.0::DOUBLE ELSE 65.0::DOUBLE END) / 400.0::DOUBLE))) END
      FROM gs g JOIN elo e ON g.o_custkey = e.o_custkey AND g.seq = e.seq + 1)
"""


def rated_orders(spark, sf):
    orders = table(spark, sf, "orders").withColumns({"season": F.year("o_orderdate"), **_sides()})
    return affine_rating(orders, ["o_custkey"], ORDER, "season", "outcome", "home")


@query(
    "affine_rating",
    f"""
    WITH RECURSIVE {RATING_SQL}
    SELECT o_orderkey, o_custkey, season, outcome, seq AS rating_seq, ROUND(pre, 4) AS rating_pre, ROUND(post, 4) AS rating_post FROM elo
    """,
)
def rating(spark, sf):
    return rated_orders(spark, sf).select(
        "o_orderkey", "o_custkey", "season", "outcome", "rating_seq",
        F.round("rating_pre", 4).alias("rating_pre"), F.round("rating_post", 4).alias("rating_post"),
    )


@query(
    "latest_per_key",
    """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def latest_per_key(spark, sf):
    return asof.last_per_key(table(spark, sf, "events"), ["user_id", "event_type"], "ts", ["event_id"], ["event_id", "ts", "value"])


OPEN_CLOSE_SQL = """
    oc AS (SELECT user_id, event_type, COUNT(*) AS n_snapshots, arg_min(value, ts) - 10 AS open_line, arg_max(value, ts) - 10 AS close_line,
             MIN(ts) AS open_ts, MAX(ts) AS close_ts FROM events GROUP BY 1, 2)
"""


def open_close(spark, sf):
    """First and last value per market in one aggregation."""
    rank = F.struct("ts", "event_id")
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n_snapshots"),
        (F.min_by("value", rank) - 10).alias("open_line"),
        (F.max_by("value", rank) - 10).alias("close_line"),
        F.min("ts").alias("open_ts"),
        F.max("ts").alias("close_ts"),
    )


@query(
    "open_close_move",
    f"""
    WITH {OPEN_CLOSE_SQL}
    SELECT user_id, event_type, ROUND(open_line, 4) AS open_line, ROUND(close_line, 4) AS close_line, ROUND(close_line - open_line, 4) AS move,
      ROUND(abs(close_line - open_line), 4) AS abs_move,
      CASE WHEN open_line > 0 AND close_line < 0 OR open_line < 0 AND close_line > 0 THEN 1 ELSE 0 END AS flip,
      ROUND(CASE WHEN abs(open_line) > 0.5::DOUBLE THEN abs(close_line - open_line) / abs(open_line) ELSE abs(close_line - open_line) END, 6) AS volatility
    FROM oc
    """,
)
def open_close_move(spark, sf):
    out = open_close(spark, sf).withColumn("m", odds.movement("open_line", "close_line"))
    return out.select(
        "user_id", "event_type", F.round("open_line", 4).alias("open_line"), F.round("close_line", 4).alias("close_line"),
        F.round("m.move", 4).alias("move"), F.round("m.abs_move", 4).alias("abs_move"), "m.flip",
        F.round("m.volatility", 6).alias("volatility"),
    )


def _crossed_sql(keys):
    parts = []
    for k in [s * k for k in keys for s in (1, -1)]:
        parts.append(f"(open_line < {k} AND close_line >= {k}) OR (open_line > {k} AND close_line <= {k})")
    return " OR ".join(parts)


KEY_NUMBERS = (3, 7, 10)


@query(
    "key_crossings",
    f"""
    WITH {OPEN_CLOSE_SQL}
    SELECT user_id, event_type, {_crossed_sql([3])} AS crossed_3, {_crossed_sql(KEY_NUMBERS)} AS crossed_any,
      ROUND(LEAST(abs(abs(open_line) - 3), abs(abs(open_line) - 7), abs(abs(open_line) - 10)), 4) AS open_distance
    FROM oc
    """,
)
def key_crossings(spark, sf):
    return open_close(spark, sf).select(
        "user_id", "event_type",
        odds.crossed("open_line", "close_line", [3]).alias("crossed_3"),
        odds.crossed("open_line", "close_line", KEY_NUMBERS).alias("crossed_any"),
        F.round(odds.key_distance("open_line", KEY_NUMBERS), 4).alias("open_distance"),
    )


def _kinds(spark, sf, kind):
    return table(spark, sf, "events").filter(F.col("event_type") == kind)


@query(
    "nearest_join",
    """
    WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    v AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'),
    c AS (SELECT p.event_id, v.event_id AS view_id, v.value AS view_value,
            ROW_NUMBER() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(v.ts) - epoch_us(p.ts)), v.ts) AS rn FROM p JOIN v USING (user_id))
    SELECT p.event_id, p.user_id, c.view_id, c.view_value FROM p LEFT JOIN c ON p.event_id = c.event_id AND c.rn = 1
    """,
)
def nearest_join(spark, sf):
    left = _kinds(spark, sf, "purchase").select("event_id", "user_id", "ts")
    right = _kinds(spark, sf, "view").select("user_id", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"), F.col("ts").alias("view_ts"))
    return asof.nearest(left, right, ["user_id"], "ts", "view_ts", "view_id", ["view_id", "view_value"]).drop("ts")


@query(
    "latest_before_cutoff",
    """
    SELECT p.event_id, p.user_id, c.event_id AS click_id, c.value AS click_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts > c.ts
    """,
)
def latest_before_cutoff(spark, sf):
    left = _kinds(spark, sf, "purchase").select("event_id", "user_id", "ts")
    right = _kinds(spark, sf, "click").select("user_id", F.col("event_id").alias("click_id"), F.col("value").alias("click_value"), F.col("ts").alias("click_ts"))
    return asof.latest_before(left, right, ["user_id"], "ts", "click_ts", "click_id", cols=["click_id", "click_value"]).drop("ts")


@query(
    "bitemporal_latest",
    """
    WITH runs AS (SELECT event_id, user_id, value, date_trunc('day', ts) AS run_ts,
                    ts + INTERVAL (CAST(json_extract(props, '$.k') AS INTEGER)) HOUR AS target_ts FROM events WHERE event_type != 'purchase'),
    p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    latest AS (SELECT p.event_id, p.user_id, p.ts, MAX(r.run_ts) AS run_ts FROM p LEFT JOIN runs r ON p.user_id = r.user_id AND r.run_ts < p.ts GROUP BY ALL),
    c AS (SELECT l.event_id, r.event_id AS forecast_id, r.value AS forecast_value, l.run_ts,
            ROW_NUMBER() OVER (PARTITION BY l.event_id ORDER BY abs(epoch_us(r.target_ts) - epoch_us(l.ts)), r.target_ts, r.event_id DESC) AS rn
          FROM latest l JOIN runs r ON l.user_id = r.user_id AND l.run_ts = r.run_ts)
    SELECT p.event_id, p.user_id, c.forecast_id, c.forecast_value, c.run_ts FROM p LEFT JOIN c ON p.event_id = c.event_id AND c.rn = 1
    """,
)
def bitemporal_latest(spark, sf):
    events_ = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    runs = events_.filter(F.col("event_type") != "purchase").select(
        "user_id", F.col("event_id").alias("forecast_id"), F.col("value").alias("forecast_value"),
        F.date_trunc("day", "ts").alias("run_ts"), F.timestamp_add("HOUR", k, F.col("ts").cast("timestamp")).alias("target_ts"),
    )
    left = _kinds(spark, sf, "purchase").select("event_id", "user_id", "ts")
    out = asof.latest_safe_forecast(
        left, runs, ["user_id"], "ts", "run_ts", "ts", "target_ts", "forecast_id", ["forecast_id", "forecast_value", "run_ts"]
    )
    return out.select("event_id", "user_id", "forecast_id", "forecast_value", F.col("run_ts").cast("timestamp_ntz").alias("run_ts"))


def _with_kickoff(spark, sf):
    """Events with the time of their user's last purchase, an aggregate broadcast or shuffled by Spark."""
    last = _kinds(spark, sf, "purchase").groupBy("user_id").agg(F.max("ts").alias("kickoff"))
    return table(spark, sf, "events").join(last, "user_id")


def _buckets(spark, sf):
    return horizons.bucket_latest(
        _with_kickoff(spark, sf), ["user_id", "event_type"], "ts", "kickoff", ["event_id"], cols=["event_id", "ts", "value"]
    )


BUCKET_SQL = """
    k AS (SELECT user_id, MAX(ts) AS kickoff FROM events WHERE event_type = 'purchase' GROUP BY 1),
    h AS (SELECT e.*, (epoch_us(k.kickoff) - epoch_us(e.ts)) / 3.6e9::DOUBLE AS hours_before FROM events e JOIN k USING (user_id)),
    b AS (SELECT *, CASE WHEN hours_before > 120 THEN 'open' WHEN hours_before >= 72 THEN '72h' WHEN hours_before >= 24 THEN '24h'
            WHEN hours_before >= 6 THEN '6h' WHEN hours_before >= 1 THEN '1h' ELSE 'close' END AS time_bucket FROM h WHERE hours_before >= 0),
    r AS (SELECT user_id, event_type, time_bucket, event_id, ts, value, hours_before FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, event_type, time_bucket ORDER BY ts DESC, event_id DESC) AS rn FROM b) WHERE rn = 1)
"""


@query(
    "horizon_buckets",
    f"WITH {BUCKET_SQL} SELECT user_id, event_type, time_bucket, event_id, ts, value, ROUND(hours_before, 6) AS hours_before FROM r",
)
def horizon_buckets(spark, sf):
    return _buckets(spark, sf).withColumn("hours_before", F.round("hours_before", 6))


@query(
    "horizon_pivot",
    f"""
    WITH {BUCKET_SQL}
    SELECT user_id, event_type, MAX(CASE WHEN time_bucket = '72h' THEN value END) AS line_72h, MAX(CASE WHEN time_bucket = '24h' THEN value END) AS line_24h,
      MAX(CASE WHEN time_bucket = '6h' THEN value END) AS line_6h, MAX(CASE WHEN time_bucket = '1h' THEN value END) AS line_1h
    FROM r GROUP BY 1, 2
    """,
)
def horizon_pivot(spark, sf):
    return horizons.pivot(_buckets(spark, sf), ["user_id", "event_type"], "value", ["72h", "24h", "6h", "1h"])


@query(
    "horizon_expand",
    f"""
    WITH {BUCKET_SQL},
    hz AS (SELECT * FROM (VALUES ('early_week', 120, 'open'), ('mid_week', 72, '72h'), ('pre_kickoff', 1, '1h')) t(prediction_horizon, hours_before_event, bucket)),
    m AS (SELECT DISTINCT user_id, event_type FROM events)
    SELECT m.user_id, m.event_type, hz.prediction_horizon, hz.hours_before_event, r.value AS line, CASE WHEN r.value IS NOT NULL THEN 1 ELSE 0 END AS line_available
    FROM m CROSS JOIN hz LEFT JOIN r ON m.user_id = r.user_id AND m.event_type = r.event_type AND r.time_bucket = hz.bucket
    """,
)
def horizon_expand(spark, sf):
    markets = table(spark, sf, "events").select("user_id", "event_type").distinct()
    return horizons.attach(
        horizons.expand(markets), _buckets(spark, sf), ["user_id", "event_type"], value="value", out="line"
    )


@query(
    "consensus_dispersion",
    """
    SELECT CAST(ts AS DATE) AS day, event_type, COUNT(DISTINCT CAST(json_extract(props, '$.k') AS INTEGER) % 5) AS book_count,
      ROUND(AVG(ln(1 + value)), 6) AS consensus_line, ROUND(MIN(ln(1 + value)), 6) AS line_min, ROUND(MAX(ln(1 + value)), 6) AS line_max,
      ROUND(stddev_pop(ln(1 + value)), 6) AS line_stddev, ROUND(MAX(ln(1 + value)) - MIN(ln(1 + value)), 6) AS line_range, ROUND(AVG(1 / (1 + value)), 4) AS consensus_prob
    FROM events GROUP BY 1, 2
    """,
)
def consensus_dispersion(spark, sf):
    rows = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), "event_type", F.log(1 + F.col("value")).alias("value"), (1 / (1 + F.col("value"))).alias("prob"),
        (F.get_json_object("props", "$.k").cast("int") % 5).alias("book"),
    )
    out = consensus.consensus(rows, ["day", "event_type"], "book", "value", "prob")
    lines = ("consensus_line", "line_min", "line_max", "line_stddev", "line_range")
    return out.withColumns({**{c: F.round(c, 6) for c in lines}, "consensus_prob": F.round("consensus_prob", 4)})


@query(
    "fair_probability",
    """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, MAX(CASE WHEN event_type = 'view' THEN value END) AS v, MAX(CASE WHEN event_type = 'click' THEN value END) AS c
               FROM events GROUP BY 1)
    SELECT day, v AS prob_view, c AS prob_click, ROUND(v / (v + c), 6) AS fair_view, ROUND(c / (v + c), 6) AS fair_click, ROUND((v + c - 1) * 100, 6) AS vig_pct FROM d
    """,
)
def fair_probability(spark, sf):
    rows = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    out = consensus.fair_two_way(rows, ["day"], "event_type", "value", ("view", "click"))
    return out.withColumns({c: F.round(c, 6) for c in ("fair_view", "fair_click", "vig_pct")})


@query(
    "upsert_latest",
    """
    WITH old AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice, 0 AS n FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    new AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice, 1 AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01')
    SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate, o_totalprice FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY n DESC, o_orderdate DESC, o_orderkey DESC) AS rn
      FROM (SELECT * FROM old UNION ALL SELECT * FROM new)) WHERE rn = 1
    """,
)
def upsert_latest(spark, sf):
    cols = ["o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice"]
    orders = table(spark, sf, "orders").select(*cols)
    at = F.col("o_orderdate")
    old = orders.filter(at < F.lit("1999-01-01").cast("timestamp_ntz"))
    new = orders.filter(at >= F.lit("1998-06-01").cast("timestamp_ntz"))
    return facts.upsert(old, new, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query(
    "mart_wide",
    f"""
    WITH RECURSIVE {ORDER_FORM_SQL}, {RATING_SQL},
    form AS (SELECT o_orderkey, AVG(o_totalprice) OVER w AS price_std, AVG(return_rate) OVER w AS rate_std, COUNT(*) OVER w AS games_played FROM f
             WINDOW w AS (PARTITION BY o_custkey, season ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    nat AS (SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT f.o_orderkey, f.season, n.n_name AS nation, n.r_name AS region, f.n_lines, ROUND(form.price_std, 4) AS price_std, ROUND(form.rate_std, 4) AS rate_std,
      form.games_played, ROUND(e.pre, 4) AS rating_pre, CASE WHEN f.n_lines IS NOT NULL THEN 1 ELSE 0 END AS lines_available,
      CAST(NULL AS DOUBLE) AS weather_score, CASE WHEN f.season < 1998 THEN 'train' WHEN f.season <= 1999 THEN 'validation' ELSE 'test' END AS split
    FROM f JOIN form USING (o_orderkey) JOIN elo e USING (o_orderkey) LEFT JOIN nat n ON f.o_custkey = n.c_custkey WHERE form.games_played >= 2
    """,
)
def mart_wide(spark, sf):
    out = wide_mart(spark, sf)
    out = marts.drop_zone(out, 3)
    return out.select(
        "o_orderkey", "season", "nation", "region", "n_lines", F.round("price_std", 4).alias("price_std"),
        F.round("rate_std", 4).alias("rate_std"), "games_played", F.round("rating_pre", 4).alias("rating_pre"),
        "lines_available", "weather_score", "split",
    )


def wide_mart(spark, sf):
    """Orders with form, rating and customer context: the mart the model queries train on."""
    keys = ["o_custkey", "season"]
    base = order_form(spark, sf)
    orders = table(spark, sf, "orders").withColumn("season", F.year("o_orderdate"))
    # Form and rating run over the same keys in the same order: one profile serves both.
    hot = profile(orders, keys, ORDER)
    form = rolling.lagged(
        base, keys, ORDER, ["o_totalprice", "return_rate"], {"std": None},
        names={("o_totalprice", "std"): "price_std", ("return_rate", "std"): "rate_std"}, hot=hot,
    )
    nations = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    out = form.withColumns(_sides())
    out = affine_rating(out, ["o_custkey"], ORDER, "season", "outcome", "home", hot=hot)
    out = marts.assemble(out, [marts.Join(nations, {"o_custkey": "c_custkey"}, {"nation": "n_name", "region": "r_name"})])
    out = out.withColumns(
        {"lines_available": F.col("n_lines").isNotNull().cast("int"), "split": marts.temporal_split("season", 1998, 1999)}
    )
    return marts.placeholder(marts.min_history(out, ["games_played"], 2), {"weather_score": "double"})
