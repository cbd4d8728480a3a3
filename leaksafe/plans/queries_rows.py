"""Row-level queries: typing, codes, flags, ratios, reshaping, joins by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaksafe.functions import clocks, features, geo, odds
from leaksafe.operators import clean, events, joins, reshape
from leaksafe.operators.events import Agg
from leaksafe.plans.registry import query, table

SEGMENT_GROUPS = {"AUTOMOBILE": "durable", "MACHINERY": "durable", "FURNITURE": "durable", "HOUSEHOLD": "home"}
PRIORITY_LEVELS = {"1-URGENT": 4, "2-HIGH": 3, "3-MEDIUM": 2, "4-NOT SPECIFIED": 1}
NATION_RULES = [(r"^nation_1$", "N-ONE"), (r"nation_2\d", "N-TWENTIES"), (r"_(3|4)$", "N-LOW")]


@query(
    "typed_projection",
    """
    SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no,
           COALESCE(TRY_CAST(o_orderpriority AS INTEGER), -1) AS dirty_no,
           upper(o_orderstatus) AS status, lower(o_orderpriority) AS priority,
           COALESCE(NULLIF(o_orderstatus, 'P'), '?') AS settled_status,
           CAST(o_totalprice AS DOUBLE) AS total_price
    FROM orders
    """,
)
def typed_projection(spark, sf):
    return clean.project(
        table(spark, sf, "orders"),
        {
            "order_id": "o_orderkey",
            "order_date": ("o_orderdate", "date"),
            "priority_no": (F.substring("o_orderpriority", 1, 1), "int"),
            "dirty_no": ("o_orderpriority", "int", -1),
            "status": F.upper("o_orderstatus"),
            "priority": F.lower("o_orderpriority"),
            "settled_status": (F.nullif(F.col("o_orderstatus"), F.lit("P")), "string", "?"),
            "total_price": ("o_totalprice", "double"),
        },
        safe=True,
    )


@query(
    "code_remap",
    """
    SELECT c_custkey,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'durable' WHEN 'MACHINERY' THEN 'durable'
                WHEN 'FURNITURE' THEN 'durable' WHEN 'HOUSEHOLD' THEN 'home'
                WHEN NULL THEN NULL ELSE 'other' END AS segment_group,
           CASE c_mktsegment WHEN 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END AS segment,
           COALESCE(NULLIF(c_mktsegment, 'HOUSEHOLD'), 'n/a') AS business_segment
    FROM customer
    """,
)
def code_remap(spark, sf):
    df = table(spark, sf, "customer")
    return df.select(
        "c_custkey",
        clean.remap_expr("c_mktsegment", SEGMENT_GROUPS, "other").alias("segment_group"),
        clean.remap_expr("c_mktsegment", {"BUILDING": "CONSTRUCTION"}).alias("segment"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("HOUSEHOLD")), F.lit("n/a")).alias("business_segment"),
    )


@query(
    "name_standardise",
    """
    SELECT c.c_custkey, CAST(length(n.n_name) AS INTEGER) AS name_length,
           CASE WHEN regexp_matches(lower(n.n_name), '^nation_1$') THEN 'N-ONE'
                WHEN regexp_matches(lower(n.n_name), 'nation_2[0-9]') THEN 'N-TWENTIES'
                WHEN regexp_matches(lower(n.n_name), '_(3|4)$') THEN 'N-LOW'
                ELSE upper(n.n_name) END AS code
    FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
    """,
)
def name_standardise(spark, sf):
    nation = clean.standardise(table(spark, sf, "nation"), "n_name", NATION_RULES, out="code")
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return customers.join(nation, "n_nationkey").select("c_custkey", F.length("n_name").alias("name_length"), "code")


@query(
    "ordinal_encode",
    """
    SELECT o_orderkey, CASE upper(o_orderpriority) WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 3
           WHEN '3-MEDIUM' THEN 2 WHEN '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS urgency
    FROM orders
    """,
)
def ordinal_encode(spark, sf):
    return clean.ordinal(table(spark, sf, "orders"), "o_orderpriority", PRIORITY_LEVELS, out="urgency").select(
        "o_orderkey", "urgency"
    )


@query(
    "flags_and_buckets",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
           CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS discounted,
           CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS returned_final,
           CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_quantity < 10 THEN 'small'
                WHEN l_quantity < 25 THEN 'medium' WHEN l_quantity < 40 THEN 'large' ELSE 'bulk' END AS size_band,
           CASE WHEN l_linenumber BETWEEN 1 AND 2 THEN 'head' WHEN l_linenumber BETWEEN 3 AND 5 THEN 'body'
                ELSE 'tail' END AS line_band,
           CASE WHEN l_shipdate IS NOT NULL THEN 1 ELSE 0 END AS shipped
    FROM lineitem
    """,
)
def flags_and_buckets(spark, sf):
    df = table(spark, sf, "lineitem")
    returned = F.col("l_returnflag") == "R"
    return df.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        features.flag(F.col("l_discount") >= 0.05, "discounted"),
        features.flag(returned & (F.col("l_linestatus") == "F"), "returned_final"),
        features.bucketize(
            "l_quantity", [10, 25, 40], ["small", "medium", "large", "bulk"], first=(returned, "returned")
        ).alias("size_band"),
        features.code_ranges("l_linenumber", [(1, 2, "head"), (3, 5, "body")], "tail").alias("line_band"),
        features.available("l_shipdate").alias("shipped"),
    )


@query(
    "guarded_ratio",
    """
    SELECT l_partkey, COUNT(*) AS n_lines,
           ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END)
                 / NULLIF(SUM(l_quantity), 0), 7) AS returned_value_per_unit,
           ROUND(CASE WHEN SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) > 0
                 THEN SUM(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END)
                      / SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END) END, 7) AS returned_price
    FROM lineitem GROUP BY l_partkey
    """,
)
def guarded_ratio(spark, sf):
    returned = F.col("l_returnflag") == "R"
    out = events.rollup(
        table(spark, sf, "lineitem"),
        ["l_partkey"],
        {
            "n_lines": Agg("count"),
            "value": Agg("sum", F.when(returned, F.col("l_extendedprice")).otherwise(0.0)),
            "quantity": Agg("sum", "l_quantity"),
            "returned_price": Agg("ratio", "l_extendedprice", returned, "l_quantity"),
        },
    )
    return out.select(
        "l_partkey", "n_lines",
        F.round(features.ratio("value", "quantity"), 7).alias("returned_value_per_unit"),
        F.round("returned_price", 7).alias("returned_price"),
    )


@query(
    "capped_score",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice,
           ROUND(CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE LEAST(100.0::DOUBLE,
                 LEAST(GREATEST((l_quantity - 10) * 1.5::DOUBLE, 0.0::DOUBLE), 40.0::DOUBLE)
               + LEAST(GREATEST((l_extendedprice - 20000) * 0.001::DOUBLE, 0.0::DOUBLE), 50.0::DOUBLE)
               + LEAST(GREATEST((l_tax - 0.02::DOUBLE) * 500.0::DOUBLE, 0.0::DOUBLE), 20.0::DOUBLE)) END, 6) AS score,
           CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE ELSE l_tax END AS effective_tax
    FROM lineitem
    """,
)
def capped_score(spark, sf):
    returned = F.col("l_returnflag") == "R"
    score = features.capped_score(
        [("l_quantity", 10, 1.5, 40), ("l_extendedprice", 20000, 0.001, 50), ("l_tax", 0.02, 500, 20)],
        100,
        override=(returned, 0),
    )
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.round(score, 6).alias("score"),
        features.override("l_tax", returned, 0.0).alias("effective_tax"),
    )


@query(
    "null_tolerant_exclude",
    """
    SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, o_totalprice FROM orders
    WHERE (NULLIF(o_orderstatus, 'P') NOT IN ('F') OR NULLIF(o_orderstatus, 'P') IS NULL)
      AND o_totalprice BETWEEN 1000 AND 400000 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')
      AND o_custkey IS NOT NULL AND o_orderpriority != '5-LOW'
    """,
)
def null_tolerant_exclude(spark, sf):
    df = table(spark, sf, "orders").withColumn("status", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    df = clean.exclude(df, "status", ["F"])
    wanted = F.col("o_totalprice").between(1000, 400000) & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
    wanted = wanted & F.col("o_custkey").isNotNull() & (F.col("o_orderpriority") != "5-LOW")
    return df.filter(wanted).select("o_orderkey", "status", "o_totalprice")


@query(
    "outcome_flag",
    """
    SELECT o_orderkey,
           CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome,
           CASE WHEN o_orderstatus IN ('F', 'O') THEN 1 ELSE 0 END AS outcome_available,
           CASE WHEN o_totalprice > 250000 THEN 1 WHEN o_totalprice < 250000 THEN 0 END AS over_line,
           CASE WHEN o_totalprice - 250000 > -(-1500.0::DOUBLE) THEN 1 WHEN o_totalprice - 250000 < -(-1500.0::DOUBLE) THEN 0 END AS covered,
           ROUND((month(o_orderdate) - 1) / 11.0::DOUBLE, 4) AS year_progress
    FROM orders
    """,
)
def outcome_flag(spark, sf):
    left = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0)
    df = table(spark, sf, "orders").withColumn("points", left)
    outcome = features.outcome_flag(F.col("points"), 1 - F.col("points"))
    return df.select(
        "o_orderkey",
        outcome.alias("outcome"),
        features.available("points").alias("outcome_available"),
        features.over_flag("o_totalprice", F.lit(250000.0)).alias("over_line"),
        features.cover_flag(F.col("o_totalprice") - 250000, F.lit(-1500.0)).alias("covered"),
        F.round(features.progress(F.month("o_orderdate"), 11), 4).alias("year_progress"),
    )


def _order_rollup(lineitem):
    returned = F.col("l_returnflag") == "R"
    return events.rollup(
        lineitem,
        ["l_orderkey"],
        {
            "n_lines": Agg("count"),
            "n_parts": Agg("distinct", "l_partkey"),
            "quantity": Agg("sum", "l_quantity"),
            "avg_price_returned": Agg("avg", "l_extendedprice", returned),
            "return_rate": Agg("rate", returned),
            "n_returned": Agg("count", None, returned),
            "discounted_quantity": Agg("sum", "l_quantity", F.col("l_discount") > 0),
            "returned_share": Agg("ratio", F.when(returned, F.col("l_quantity")).otherwise(0.0), None, "l_quantity"),
            "first_ship": Agg("min", "l_shipdate"),
            "last_ship": Agg("max", "l_shipdate"),
        },
    )


@query(
    "event_rollup",
    """
    SELECT l_orderkey, COUNT(*) AS n_lines, COUNT(DISTINCT l_partkey) AS n_parts, ROUND(SUM(l_quantity), 4) AS quantity,
           ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END), 4) AS avg_price_returned,
           ROUND(AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS return_rate,
           COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned,
           ROUND(SUM(CASE WHEN l_discount > 0 THEN l_quantity END), 4) AS discounted_quantity,
           ROUND(CASE WHEN SUM(l_quantity) > 0 THEN SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / SUM(l_quantity) END, 4) AS returned_share,
           MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
    FROM lineitem GROUP BY l_orderkey
    """,
)
def event_rollup(spark, sf):
    out = _order_rollup(table(spark, sf, "lineitem"))
    rounded = ("quantity", "avg_price_returned", "return_rate", "discounted_quantity", "returned_share")
    return out.withColumns({c: F.round(c, 4) for c in rounded})


def _trades(spark, sf):
    """Line items with the nation that bought and the nation that sold."""
    lines = table(spark, sf, "lineitem")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("buyer"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("seller"))
    return lines.join(orders, "l_orderkey").join(customers, "o_custkey").join(suppliers, "l_suppkey")


TRADES_SQL = """
    trades AS (
      SELECT l.*, o.o_custkey, o.o_orderdate, c.c_nationkey AS buyer, s.s_nationkey AS seller
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey)
"""


@query(
    "two_sided_rollup",
    f"""
    WITH {TRADES_SQL},
    b AS (SELECT year(o_orderdate) AS season, buyer AS nation, COUNT(*) AS bought_lines, AVG(l_extendedprice) AS bought_price
          FROM trades GROUP BY 1, 2),
    s AS (SELECT year(o_orderdate) AS season, seller AS nation, COUNT(*) AS sold_lines,
                 AVG(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS returned_rate
          FROM trades GROUP BY 1, 2)
    SELECT CAST(season AS INTEGER) AS season, nation, bought_lines, ROUND(bought_price, 4) AS bought_price, sold_lines,
           ROUND(returned_rate, 4) AS returned_rate
    FROM b FULL JOIN s USING (season, nation)
    """,
)
def two_sided_rollup(spark, sf):
    trades = _trades(spark, sf).withColumn("season", F.year("o_orderdate"))
    out = events.two_sided_rollup(
        trades, ["season"], "buyer", "seller",
        {"bought_lines": Agg("count"), "bought_price": Agg("avg", "l_extendedprice")},
        {"sold_lines": Agg("count"), "returned_rate": Agg("rate", F.col("l_returnflag") == "R")},
        entity="nation",
    )
    return out.withColumns({"bought_price": F.round("bought_price", 4), "returned_rate": F.round("returned_rate", 4)})


@query(
    "unpivot_sides",
    f"""
    WITH {TRADES_SQL},
    sides AS (
      SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, buyer AS nation, seller AS other_nation,
             l_extendedprice AS amount_for, l_extendedprice * l_discount AS amount_against, 1 AS buyer_flag FROM trades
      UNION ALL
      SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, seller, buyer, l_extendedprice * l_discount, l_extendedprice, 0
      FROM trades)
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, nation, other_nation, buyer_flag, ROUND(amount_for, 4) AS amount_for,
           ROUND(amount_for - amount_against, 4) AS margin,
           CASE WHEN amount_for > amount_against THEN 1 WHEN amount_for < amount_against THEN 0 END AS ahead_flag
    FROM sides
    """,
)
def unpivot_sides(spark, sf):
    discount = F.col("l_extendedprice") * F.col("l_discount")
    sides = reshape.two_sides(
        _trades(spark, sf),
        {"nation": "buyer", "other_nation": "seller", "amount_for": "l_extendedprice", "amount_against": discount},
        {"nation": "seller", "other_nation": "buyer", "amount_for": discount, "amount_against": "l_extendedprice"},
        flag="buyer_flag",
        keep=["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"],
    )
    return sides.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "nation", "other_nation", "buyer_flag",
        F.round("amount_for", 4).alias("amount_for"),
        F.round(F.col("amount_for") - F.col("amount_against"), 4).alias("margin"),
        features.outcome_flag("amount_for", "amount_against").alias("ahead_flag"),
    )


@query(
    "canonical_entities",
    """
    SELECT DISTINCT CASE code WHEN 'NATION_7' THEN 'NATION_8' ELSE code END AS entity FROM (
      SELECT n_name AS code FROM customer JOIN nation ON c_nationkey = n_nationkey
      UNION ALL SELECT n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) t
    WHERE code IS NOT NULL
    """,
)
def canonical_entities(spark, sf):
    nation = table(spark, sf, "nation")
    buyers = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sellers = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return clean.canonical_entities([(buyers, "n_name"), (sellers, "n_name")], {"NATION_7": "NATION_8"})


@query(
    "union_by_name",
    """
    SELECT 'customer' AS kind, c_custkey AS party, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal, NULL FROM supplier
    """,
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("party"), F.lit("supplier").alias("kind"),
        F.col("s_nationkey").alias("nation"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "wide_to_long",
    """
    SELECT p_partkey, 'size' AS market_type, 'unit' AS selection, CAST(p_size AS DOUBLE) AS line, -110 AS price FROM part
    UNION ALL SELECT p_partkey, 'price', 'over', p_retailprice, -110 FROM part
    UNION ALL SELECT p_partkey, 'price', 'under', -p_retailprice, 100 + p_size FROM part
    """,
)
def wide_to_long(spark, sf):
    return reshape.wide_to_long(
        table(spark, sf, "part"),
        ["p_partkey"],
        [
            {"market_type": F.lit("size"), "selection": F.lit("unit"), "line": F.col("p_size").cast("double"), "price": F.lit(-110)},
            {"market_type": F.lit("price"), "selection": F.lit("over"), "line": F.col("p_retailprice"), "price": F.lit(-110)},
            {"market_type": F.lit("price"), "selection": F.lit("under"), "line": -F.col("p_retailprice"), "price": 100 + F.col("p_size")},
        ],
    )


@query(
    "pair_rows",
    """
    WITH n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations WHERE role != 'system')
    SELECT conv_id, CAST((rn + 1) // 2 AS BIGINT) AS pair_no,
           MAX(CASE WHEN rn % 2 = 1 THEN role END) AS ask_role, MAX(CASE WHEN rn % 2 = 1 THEN length(text) END) AS ask_chars,
           MAX(CASE WHEN rn % 2 = 0 THEN role END) AS reply_role, MAX(CASE WHEN rn % 2 = 0 THEN length(text) END) AS reply_chars,
           CAST(COUNT(*) = 2 AS INTEGER) AS complete
    FROM n GROUP BY 1, 2
    """,
)
def pair_rows(spark, sf):
    rows = table(spark, sf, "conversations").filter("role != 'system'")
    rows = rows.select("conv_id", "turn", "role", F.length("text").cast("bigint").alias("chars"))
    return reshape.pair_rows(rows, ["conv_id"], ["turn"], ["role", "chars"], ("ask", "reply"))


@query(
    "pivot_measures",
    """
    SELECT l_suppkey,
      COALESCE(ROUND(SUM(CASE WHEN l_returnflag = 'A' THEN l_quantity END), 4), 0) AS "A_quantity",
      COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) AS "A_lines",
      COALESCE(ROUND(SUM(CASE WHEN l_returnflag = 'N' THEN l_quantity END), 4), 0) AS "N_quantity",
      COUNT(CASE WHEN l_returnflag = 'N' THEN 1 END) AS "N_lines",
      COALESCE(ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 4), 0) AS "R_quantity",
      COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS "R_lines"
    FROM lineitem GROUP BY l_suppkey
    """,
)
def pivot_measures(spark, sf):
    return reshape.pivot_measures(
        table(spark, sf, "lineitem"), ["l_suppkey"], "l_returnflag", ["A", "N", "R"],
        {
            "quantity": lambda here: F.round(F.sum(F.when(here, F.col("l_quantity"))), 4),
            "lines": lambda here: F.count_if(here),
        },
    )


@query(
    "role_join",
    f"""
    WITH {TRADES_SQL},
    form AS (SELECT s_nationkey AS nation, AVG(s_acctbal) AS avg_balance, COUNT(*) AS n_suppliers FROM supplier GROUP BY 1)
    SELECT t.l_orderkey, t.l_partkey, t.l_linenumber, t.l_quantity, t.buyer, t.seller,
           ROUND(b.avg_balance, 4) AS home_avg_balance, b.n_suppliers AS home_n_suppliers,
           ROUND(s.avg_balance, 4) AS away_avg_balance, s.n_suppliers AS away_n_suppliers,
           ROUND(b.avg_balance - s.avg_balance, 4) AS balance_diff, b.n_suppliers + s.n_suppliers AS n_suppliers_sum,
           ROUND(CASE WHEN t.l_returnflag = 'R' THEN b.avg_balance ELSE s.avg_balance END, 4) AS liable_balance
    FROM trades t LEFT JOIN form b ON t.buyer = b.nation LEFT JOIN form s ON t.seller = s.nation
    """,
)
def role_join(spark, sf):
    form = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.avg("s_acctbal").alias("avg_balance"), F.count(F.lit(1)).alias("n_suppliers")
    )
    out = joins.role_join(
        _trades(spark, sf), form, {"home": "buyer", "away": "seller"}, "nation", ["avg_balance", "n_suppliers"]
    )
    out = features.role_diff(out, {"balance_diff": "avg_balance"})
    out = features.role_sum(out, ["n_suppliers"])
    liable = features.pick_by_role(
        features.flag(F.col("l_returnflag") == "R"), "home_avg_balance", "away_avg_balance"
    )
    return out.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "buyer", "seller",
        F.round("home_avg_balance", 4).alias("home_avg_balance"), "home_n_suppliers",
        F.round("away_avg_balance", 4).alias("away_avg_balance"), "away_n_suppliers",
        F.round("balance_diff", 4).alias("balance_diff"), "n_suppliers_sum", F.round(liable, 4).alias("liable_balance"),
    )


@query(
    "either_key_join",
    f"""
    WITH {TRADES_SQL}
    SELECT t.l_orderkey, t.l_partkey, t.l_linenumber, t.l_quantity, t.buyer, t.seller, n.n_nationkey, n.n_name
    FROM trades t JOIN nation n ON t.buyer = n.n_nationkey OR t.seller = n.n_nationkey
    """,
)
def either_key_join(spark, sf):
    out = joins.either_key_join(_trades(spark, sf), table(spark, sf, "nation"), "n_nationkey", ["buyer", "seller"])
    return out.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "buyer", "seller", "n_nationkey", "n_name")


@query(
    "validity_join",
    """
    WITH tariff AS (
      SELECT s_nationkey AS nation, year(MIN(o_orderdate)) + (s_nationkey % 3) AS valid_from,
             CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE year(MIN(o_orderdate)) + 3 + (s_nationkey % 3) END AS valid_to,
             ROUND(AVG(s_acctbal) / 1000, 4) AS rate
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey)
    SELECT o.o_orderkey, c.c_nationkey, CAST(t.valid_from AS BIGINT) AS valid_from, CAST(t.valid_to AS BIGINT) AS valid_to, t.rate
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN tariff t ON c.c_nationkey = t.nation AND year(o.o_orderdate) BETWEEN t.valid_from AND COALESCE(t.valid_to, year(o.o_orderdate))
    """,
)
def validity_join(spark, sf):
    sold = _trades(spark, sf).groupBy(F.col("seller").alias("c_nationkey")).agg(F.year(F.min("o_orderdate")).alias("y"))
    rates = (
        table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.round(F.avg("s_acctbal") / 1000, 4).alias("rate"))
    )
    start = (F.col("y") + F.col("c_nationkey") % 3).cast("bigint")
    end = F.when(F.col("c_nationkey") % 4 != 0, start + 3)
    tariff = sold.join(rates, "c_nationkey").select(
        "c_nationkey", start.alias("valid_from"), end.alias("valid_to"), "rate"
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf, "orders").join(customers, "o_custkey")
    out = joins.validity_join(orders, tariff, "c_nationkey", F.year("o_orderdate"), "valid_from", "valid_to")
    return out.select("o_orderkey", "c_nationkey", "valid_from", "valid_to", "rate")


@query(
    "fill_key",
    """
    WITH blanked AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS known FROM orders),
    look AS (SELECT o_custkey, o_orderdate, MIN(o_orderkey) AS found FROM orders GROUP BY 1, 2)
    SELECT b.o_custkey, b.o_orderdate, b.o_totalprice, COALESCE(b.known, l.found) AS order_ref
    FROM blanked b LEFT JOIN look l ON b.o_custkey = l.o_custkey AND b.o_orderdate = l.o_orderdate
    """,
)
def fill_key(spark, sf):
    orders = table(spark, sf, "orders")
    blanked = orders.select(
        "o_custkey", "o_orderdate", "o_totalprice", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("order_ref")
    )
    lookup = orders.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("order_ref"))
    return joins.fill_key(blanked, lookup, ["o_custkey", "o_orderdate"], "order_ref")


@query(
    "unique_left_join",
    """
    WITH one AS (SELECT * FROM (SELECT user_id, event_type, value,
        ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1)
    SELECT o.o_orderkey, o.o_custkey, e.event_type, e.value FROM orders o LEFT JOIN one e ON o.o_custkey = e.user_id
    """,
)
def unique_left_join(spark, sf):
    side = table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"), "event_type", "value", "event_id")
    out = joins.unique_left(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey"), side, ["o_custkey"], [-F.col("value"), F.col("event_id")]
    )
    return out.drop("event_id")


@query(
    "anti_join",
    """
    SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
    """,
)
def anti_join(spark, sf):
    from leaksafe.operators.quality import relationships

    parents = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return relationships(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), parents, ["o_orderkey"])


def _places(spark, sf):
    """A pseudo location per nation and year in which it traded."""
    key = F.col("nation")
    # Both roles from one read.
    seen = _trades(spark, sf).select(F.year("o_orderdate").alias("season"), F.explode(F.array("buyer", "seller")).alias("nation"))
    zones = F.array(*[F.lit(z) for z in ("America/New_York", "America/Denver", "Europe/London", "Asia/Kolkata", "Asia/Tokyo")])
    return seen.distinct().select(
        "season", key.alias("team"),
        (key * 5.0 - 60).alias("latitude"), (key * 13.0 - 150).alias("longitude"),
        F.element_at(zones, key % 5 + 1).alias("timezone"),
    )


@query(
    "pair_distances",
    f"""
    WITH {TRADES_SQL},
    pairs AS (SELECT DISTINCT year(o_orderdate) AS season, buyer AS home_team, seller AS away_team FROM trades WHERE buyer != seller),
    geo AS (SELECT *, radians(home_team * 5.0::DOUBLE - 60) AS lat1, radians(away_team * 5.0::DOUBLE - 60) AS lat2,
               radians(home_team * 13.0::DOUBLE - 150) AS lon1, radians(away_team * 13.0::DOUBLE - 150) AS lon2 FROM pairs),
    h AS (SELECT *, pow(sin((lat2 - lat1) / 2), 2) + cos(lat1) * cos(lat2) * pow(sin((lon2 - lon1) / 2), 2) AS a,
            [-4.0, -6.0, 0.0, 5.5, 9.0]::DOUBLE[] AS zone FROM geo),
    z AS (SELECT *, zone[home_team % 5 + 1] - zone[away_team % 5 + 1] AS shift FROM h)
    SELECT CAST(season AS INTEGER) AS season, home_team, away_team, ROUND(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)), 4) AS travel_km,
           shift AS timezone_shift_hours, CASE WHEN shift < -1 THEN 1 ELSE 0 END AS east_to_west_flag,
           CASE WHEN shift > 1 THEN 1 ELSE 0 END AS west_to_east_flag,
           CASE WHEN abs(home_team - away_team) * 5 > 20 OR abs(home_team - away_team) * 13 > 50 THEN 1 ELSE 0 END AS international_travel_flag
    FROM z
    """,
)
def pair_distances(spark, sf):
    pairs = _trades(spark, sf).select(
        F.year("o_orderdate").alias("season"), F.col("buyer").alias("home_team"), F.col("seller").alias("away_team")
    ).filter("home_team != away_team")
    out = geo.pair_distances(pairs, _places(spark, sf))
    return out.select(
        "season", "home_team", "away_team", F.round("travel_km", 4).alias("travel_km"), "timezone_shift_hours",
        "east_to_west_flag", "west_to_east_flag", "international_travel_flag",
    )


@query(
    "expand_validity",
    """
    WITH span AS (SELECT o_custkey, year(MIN(o_orderdate)) AS first_year,
                         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE year(MAX(o_orderdate)) END AS last_year
                  FROM orders GROUP BY o_custkey)
    SELECT o_custkey, CAST(UNNEST(range(GREATEST(first_year, 1996), LEAST(COALESCE(last_year, 2000), 2000) + 1)) AS INTEGER) AS season
    FROM span
    """,
)
def expand_validity(spark, sf):
    span = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.year(F.min("o_orderdate")).alias("first_year"),
        F.when(F.col("o_custkey") % 3 != 0, F.year(F.max("o_orderdate"))).alias("last_year"),
    )
    return geo.expand_validity(span, "first_year", "last_year", 1996, 2000).select("o_custkey", "season")


@query(
    "odds_math",
    """
    WITH p AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -round(value * 40) ELSE round(value * 40) END AS american, value,
                 value / 2 - 4 AS spread FROM events),
    q AS (SELECT *, CASE WHEN american >= 100 THEN american / 100 + 1 WHEN american <= -100 THEN -100 / american + 1 END AS dec,
               CASE WHEN american >= 100 THEN 100 / (american + 100) WHEN american <= -100 THEN -american / (-american + 100) END AS ip FROM p),
    e AS (SELECT *, CASE WHEN american > 0 THEN american WHEN american < 0 THEN 100 * 100 / abs(american) END AS profit FROM q)
    SELECT event_id, american AS price, ROUND(dec, 6) AS price_decimal, ROUND(ip, 6) AS prob,
           ROUND(ip / (ip + 0.5238::DOUBLE), 6) AS fair_a, ROUND((ip + 0.5238::DOUBLE - 1) * 100, 6) AS vig_pct,
           ROUND(45 / 2.0::DOUBLE - spread / 2, 6) AS home_total, ROUND(45 / 2.0::DOUBLE + spread / 2, 6) AS away_total,
           ROUND((0.5::DOUBLE + 0.4::DOUBLE * sin(value)) * profit - (1 - (0.5::DOUBLE + 0.4::DOUBLE * sin(value))) * 100, 2) AS ev, ROUND(profit, 2) AS profit_if_win
    FROM e
    """,
)
def odds_math(spark, sf):
    price = F.round(F.col("value") * 40)
    df = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, -price).otherwise(price).alias("price"),
        (F.col("value") / 2 - 4).alias("spread"), (0.5 + 0.4 * F.sin("value")).alias("p_win"),
    )
    prob = odds.implied_prob("price")
    df = df.withColumns(
        {
            "prob": prob, "vig": odds.remove_vig(prob, F.lit(0.5238)),
            "sides": odds.side_totals(F.lit(45.0), "spread"), "bet": odds.ev("p_win", "price"),
        }
    )
    return df.select(
        "event_id", "price", F.round(odds.to_decimal("price"), 6).alias("price_decimal"), F.round("prob", 6).alias("prob"),
        F.round("vig.fair_a", 6).alias("fair_a"), F.round("vig.vig_pct", 6).alias("vig_pct"),
        F.round("sides.home", 6).alias("home_total"), F.round("sides.away", 6).alias("away_total"),
        "bet.ev", "bet.profit_if_win",
    )


@query(
    "clock_to_timestamp",
    """
    SELECT event_id, strftime(ts, '%H:%M') AS clock,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL (CAST(split_part(strftime(ts, '%H:%M'), ':', 1) AS INTEGER) * 60
             + CAST(split_part(strftime(ts, '%H:%M'), ':', 2) AS INTEGER)) MINUTE AS kickoff,
           ROUND((epoch_us(ts) - epoch_us(date_trunc('minute', ts))) / 1e6, 6) AS seconds_past,
           CAST(ts AS DATE) AS day, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_no,
           event_type || '_' || strftime(ts, '%Y%m%d') AS event_ref
    FROM events
    """,
)
def clock_to_timestamp(spark, sf):
    df = table(spark, sf, "events").withColumn("clock", F.date_format("ts", "HH:mm"))
    df = df.withColumn("kickoff", clocks.at_clock(F.to_date("ts"), "clock"))
    return df.select(
        "event_id", "clock", "kickoff",
        F.round(clocks.minutes_between("ts", "kickoff") * 60, 6).alias("seconds_past"),
        F.to_date(F.date_format("ts", "M/d/yyyy"), "M/d/y").alias("day"),
        F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))).alias("day_no"),
        F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMMdd")).alias("event_ref"),
    )


@query(
    "tz_shift",
    """
    WITH t AS (SELECT o_orderkey, o_orderdate + INTERVAL 12 HOUR AS moment, ['America/New_York', 'Asia/Kolkata', 'Asia/Tokyo'][o_orderkey % 3 + 1] AS zone FROM orders),
    b AS (SELECT *,
      -- the first Sunday of April (from 1987 to 2006) and the last Sunday of October
      make_date(year(moment), 4, 1) + CAST((7 - dayofweek(make_date(year(moment), 4, 1))) % 7 AS INTEGER) AS dst_from,
      make_date(year(moment), 10, 31) - CAST(dayofweek(make_date(year(moment), 10, 31)) AS INTEGER) AS dst_to FROM t)
    SELECT o_orderkey, zone, CASE zone WHEN 'Asia/Kolkata' THEN 5.5::DOUBLE WHEN 'Asia/Tokyo' THEN 9.0::DOUBLE
        ELSE CASE WHEN moment >= CAST(dst_from AS TIMESTAMP) + INTERVAL 7 HOUR AND moment < CAST(dst_to AS TIMESTAMP) + INTERVAL 6 HOUR
             THEN -4.0::DOUBLE ELSE -5.0::DOUBLE END END AS utc_offset
    FROM b
    """,
)
def tz_shift(spark, sf):
    zones = F.array(F.lit("America/New_York"), F.lit("Asia/Kolkata"), F.lit("Asia/Tokyo"))
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.element_at(zones, (F.col("o_orderkey") % 3 + 1).cast("int")).alias("zone"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("interval 12 hours")).alias("at"),
    )
    return df.select("o_orderkey", "zone", clocks.utc_offset_hours("zone", "at").alias("utc_offset"))
