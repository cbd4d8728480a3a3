"""Joins, reshapes, horizons, quality, evaluation, scenarios on small fixtures."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaksafe.operators import consensus, dash, evaluate, facts, horizons, joins, marts, quality, reshape, scenario
from leaksafe.operators.events import Agg, two_sided_rollup


def test_either_key_matches_once(frame, rows):
    games = frame("g int, h string, a string", (1, "x", "y"), (2, "x", "x"), (3, None, "z"))
    teams = frame("team string, v int", ("x", 1), ("y", 2))
    out = joins.either_key_join(games, teams, "team", ["h", "a"])
    assert rows(out.select("g", "team"), "g", "team") == [(1, "x"), (1, "y"), (2, "x")]
    left = joins.either_key_join(games, teams, "team", ["h", "a"], how="left", row_id=["g"])
    assert rows(left.select("g", "team"), "g", "team")[-1] == (3, None)


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_validity_is_inclusive(spark, frame, rows, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    facts_ = frame("k string, y int", ("a", 1999), ("a", 2000), ("a", 2002), ("a", 2003), ("b", 2000))
    dim = frame("k string, s int, e int, v string", ("a", 2000, 2002, "old"), ("a", 2003, None, "new"))
    out = joins.validity_join(facts_, dim, "k", "y", "s", "e")
    assert rows(out.select("k", "y", "v"), "k", "y") == [
        ("a", 1999, None), ("a", 2000, "old"), ("a", 2002, "old"), ("a", 2003, "new"), ("b", 2000, None)
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kind", ["int", "date", "timestamp", "double"])
def test_validity_equals_brute_force(spark, kind):
    """Overlapping, open, empty and missing ranges, questions before all and after all of them."""
    rng = np.random.default_rng(3)
    ranges = [(i, int(rng.integers(0, 3)), int(rng.integers(-50, 50)), int(rng.integers(0, 40)) ** 2) for i in range(120)]
    ranges = [(i, k, None if i % 17 == 0 else a, None if i % 11 == 0 else a + n - (9 if i % 13 == 0 else 0)) for i, k, a, n in ranges]
    asked = [(i, None if i % 19 == 0 else int(rng.integers(0, 4)), None if i % 23 == 0 else int(rng.integers(-100, 2000))) for i in range(300)]
    cast = {"int": "{}", "date": "date_add(date'2000-01-01', {})", "timestamp": "timestamp'2000-01-01' + make_dt_interval({})", "double": "{} + 0.5D"}[kind]
    dim = spark.createDataFrame(ranges, "d int, k int, s int, e int").selectExpr("d", "k", cast.format("s") + " AS s", cast.format("e") + " AS e")
    rows_ = spark.createDataFrame(asked, "i int, k int, at int").selectExpr("i", "k", cast.format("at") + " AS at")
    want = []
    for i, k, at in asked:
        found = [d for d, dk, s, e in ranges if k == dk and at is not None and s is not None and s <= at and (e is None or at <= e)]
        want += [(i, d) for d in found] or [(i, None)]
    key = lambda r: (r[0], r[1] or -1)
    for how, expected in (("left", want), ("inner", [w for w in want if w[1] is not None])):
        out = joins.validity_join(rows_, dim, "k", "at", "s", "e", how)
        assert out.columns == ["i", "k", "at", "d", "s", "e"]
        assert sorted(((r["i"], r["d"]) for r in out.collect()), key=key) == sorted(expected, key=key)


def test_many_versions_of_one_key_stay_linear(spark):
    """One key with 100,000 versions and 100,000 questions."""
    n = 100_000
    dim = spark.range(n).selectExpr("'a' AS k", "id * 5 AS s", f"if(id = {n - 1}, null, id * 5 + id % 5) AS e", "id AS v")
    asked = spark.range(n).selectExpr("'a' AS k", "id * 7 % 500000 AS __at").distinct()
    pairs = joins._candidates(asked, dim, ["k"], "s", "e").count()
    assert pairs < 8 * n
    out = joins.validity_join(asked.withColumnRenamed("__at", "at"), dim, "k", "at", "s", "e")
    right = F.when((F.col("at") % 5 <= F.floor(F.col("at") / 5) % 5) | (F.col("at") >= 5 * (n - 1)), F.floor(F.col("at") / 5))
    assert out.filter(~F.col("v").eqNullSafe(right)).count() == 0 and out.count() == n


def test_rules_agree_with_checks(spark, frame):
    """Fused rules count what the single checks return; broken ones are errors and leave the others alone."""
    rng = np.random.default_rng(1)
    data = [(int(rng.integers(0, 60)), None if i % 9 == 0 else int(rng.integers(0, 9)), float(rng.normal())) for i in range(200)]
    t = frame("id int, p int, v double", *data, (None, 3, None), (None, 3, 9.0))
    parents = frame("p int", *[(k,) for k in range(6)], (3,))
    rule, c = quality.Rule, F.col
    rules = [
        rule("t", "range", quality.outside("v", -1, 1)), rule("t", "ids", quality.any_null("id")), rule("t", "pairs", unique=("id", "p")),
        rule("t", "parent", parent=lambda: parents, on=("p",)), rule("t", "where", quality.outside("v", 0), where=c("p") == 2),
        rule("t", "holds", quality.fails(c("v") < 2)), rule("t", "single", unique=("id",)), rule("t", "broken", c("nope") > 1),
        rule("t", "broken_key", unique=("nope",)), rule("gone", "no_table", c("v") > 1), rule("empty", "none", quality.any_null("id")),
        rule("empty", "none_twice", unique=("id",)),
    ]
    got = {r["check_name"]: (r["status"], r["rows"]) for r in quality.run_rules(spark, {"t": t, "empty": t.limit(0)}, rules).collect()}
    single = {
        "range": quality.in_range(t, "v", -1, 1), "ids": quality.not_null(t, ["id"]), "pairs": quality.unique(t, ["id", "p"]),
        "parent": quality.relationships(t, parents, ["p"]), "where": quality.in_range(t.filter("p = 2"), "v", 0, None),
        "holds": quality.expression(t, c("v") < 2), "single": quality.unique(t, ["id"]),
    }
    want = {n: ("FAIL" if df.count() else "PASS", df.count()) for n, df in single.items()}
    assert got == {**want, **dict.fromkeys(("broken", "broken_key", "no_table"), ("ERROR", None)), "none": ("PASS", 0), "none_twice": ("PASS", 0)}


def test_contracts_are_reported_whole(frame, rows):
    rule = quality.Contract({"a": "numeric", "b": None, "c": None, "gone": None}, {"c": ("x", "y")}, lower=True)
    df = frame("a string, b int, c string", ("1", None, "X"), (None, 2, "z"), ("3", None, None))
    out = quality.contract_report(df, rule, "s")
    assert rows(out, "column_name") == [
        ("s", "a", True, False, 1, 0, 3), ("s", "b", True, True, 2, 0, 3), ("s", "c", True, True, 1, 1, 3), ("s", "gone", False, False, 3, 0, 3)
    ]
    assert rows(quality.contract_report(df.limit(0), rule), "column_name")[0] == ("", "a", True, False, 0, 0, 0)


def test_metrics_by_sets(frame):
    """Each grouping as by itself, a NULL label apart from `all`."""
    rng = np.random.default_rng(4)
    data = [(float(rng.normal()), float(rng.normal()), [None, "u", "v"][i % 3], i % 2) for i in range(60)]
    df = frame("a double, p double, g string, h int", *data)
    out = evaluate.by_sets(df, "a", "p", {"g": "g", "h": "h"}, [[], ["g"], ["g", "h"]])
    got = {(r["grouping"], r["g"], r["h"]): (r["n"], round(r["rmse"], 9)) for r in out.collect()}
    want = {}
    for name, label in (("", lambda r: (None, None)), ("g", lambda r: (r[2], None)), ("g+h", lambda r: (r[2], str(r[3])))):
        for key in {label(r) for r in data}:
            rest = [r[0] - r[1] for r in data if label(r) == key]
            want[(name, *key)] = (len(rest), round(float(np.sqrt(np.mean(np.square(rest)))), 9))
    assert got == want
    assert out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_prior_period_and_fill(frame, rows):
    now = frame("k string, p int", ("a", 1), ("a", 2))
    agg = frame("k string, p int, v int", ("a", 1, 10))
    assert rows(joins.prior_period(now, agg, ["k"], "p"), "p") == [("a", 1, None), ("a", 2, 10)]
    df = frame("k string, id int", ("a", None), ("a", 7), ("b", None))
    look = frame("k string, id int", ("a", 3), ("a", 2))
    assert rows(joins.fill_key(df, look, ["k"], "id"), "k", "id") == [("a", 2), ("a", 7), ("b", None)]


def test_unique_left_keeps_row_count(frame, rows):
    df = frame("n string, x int", ("a", 1), ("a", 2), ("b", 3))
    side = frame("n string, o int, v string", ("a", 2, "second"), ("a", 1, "first"))
    assert [r[-1] for r in rows(joins.unique_left(df, side, ["n"], [F.col("o")]), "x")] == ["first", "first", None]


def test_role_join_fixture(frame, rows):
    games = frame("g int, home string, away string", (1, "x", "y"))
    form = frame("team string, v int", ("x", 10), ("y", 20))
    out = joins.role_join(games, form, {"home": "home", "away": "away"}, "team", ["v"])
    assert rows(out.select("home_v", "away_v")) == [(10, 20)]


def test_two_sides_and_rollup(frame, rows):
    df = frame("g int, h string, a string, hs int, as_ int", (1, "x", "y", 3, 0))
    out = reshape.two_sides(df, {"team": "h", "pf": "hs"}, {"team": "a", "pf": "as_"}, keep=["g"])
    assert rows(out, "team") == [(1, "x", 3, 1), (1, "y", 0, 0)]
    plays = frame("g int, o string, d string, v double", (1, "x", "y", 2.0), (1, "x", "z", 4.0))
    rolled = two_sided_rollup(plays, ["g"], "o", "d", {"own": Agg("sum", "v")}, {"against": Agg("sum", "v")}, entity="t")
    assert rows(rolled, "t") == [(1, "x", 6.0, None), (1, "y", None, 2.0), (1, "z", None, 4.0)]


def test_pairs_report_an_unpaired_row(frame, rows):
    df = frame("k int, n int, v string", *[(1, i, c) for i, c in enumerate("abcde")])
    out = reshape.pair_rows(df, ["k"], ["n"], ["v"])
    assert rows(out.select("pair_no", "first_v", "second_v", "complete"), "pair_no") == [
        (1, "a", "b", 1), (2, "c", "d", 1), (3, "e", None, 0)
    ]


def test_horizons(frame, rows):
    at = dt.datetime(2024, 1, 10)
    snap = [("m", at - dt.timedelta(hours=h), at, i, float(h)) for i, h in enumerate((130, 100, 80, 2, 1, 0.5, -1))]
    df = frame("k string, ts timestamp, kick timestamp, id int, v double", *snap)
    out = horizons.bucket_latest(df, ["k"], "ts", "kick", ["id"], cols=["v"])
    assert {r["time_bucket"]: r["v"] for r in out.collect()} == {"open": 130.0, "72h": 80.0, "1h": 1.0, "close": 0.5}
    base = horizons.expand(df.select("k").distinct())
    got = rows(horizons.attach(base, out, ["k"], value="v").select("prediction_horizon", "v", "v_available"), "prediction_horizon")
    assert got == [("early_week", 130.0, 1), ("mid_week", 80.0, 1), ("pre_kickoff", 1.0, 1)]
    assert rows(horizons.pivot(out, ["k"], "v", ["72h", "24h"])) == [("m", 80.0, None)]


def test_upsert_last_write_wins(frame, rows):
    old = frame("k int, t int, v string", (1, 9, "old"), (2, 1, "kept"))
    new = frame("k int, t int, v string", (1, 1, "new1"), (1, 2, "new2"), (3, 1, "added"))
    assert rows(facts.upsert(old, new, ["k"], ["t"]), "k") == [(1, 2, "new2"), (2, 1, "kept"), (3, 1, "added")]


def test_consensus_fixture(frame, rows):
    df = frame("m int, b string, line double", (1, "x", 1.0), (1, "y", 3.0))
    got = consensus.consensus(df, ["m"], "b", "line").first().asDict()
    assert got == {"m": 1, "book_count": 2, "consensus_line": 2.0, "line_min": 1.0, "line_max": 3.0, "line_stddev": 1.0, "line_range": 2.0}


def test_mart_keeps_the_base_grain(frame, rows):
    base = frame("id int, t string", (1, "a"), (2, "b"), (3, None))
    side = frame("team string, v int", ("a", 5))
    out = marts.assemble(base, [marts.Join(side, {"t": "team"}, {"x": "v"})], check=True)
    assert rows(out, "id") == [(1, "a", 5), (2, "b", None), (3, None, None)]
    with pytest.raises(ValueError, match="not unique"):
        marts.assemble(base, [marts.Join(side.union(side), {"t": "team"}, {"x": "v"})], check=True)
    assert rows(marts.min_history(out, ["x"], 1)) == [(1, "a", 5)]
    assert dict(marts.placeholder(base, {"z": "double"}).dtypes)["z"] == "double"


# --- quality ---------------------------------------------------------------------------------


def test_relationships_with_null_in_parent(frame):
    child, parent = frame("k int", (1,), (2,)), frame("k int", (1,), (None,))
    assert [r[0] for r in quality.relationships(child, parent, ["k"]).collect()] == [2]


def test_run_reports_errors(spark, frame):
    df = frame("a int, b int", (1, 1), (1, None))
    out = quality.run(
        spark,
        {
            "ok": lambda: quality.in_range(df, "a", 0, 5), "bad": lambda: quality.unique(df, ["a"]),
            "wrong": lambda: quality.not_null(df, ["missing"]), "expr": lambda: quality.expression(df, F.col("b") == 1),
        },
    )
    got = {r["check_name"]: (r["status"], r["rows"]) for r in out.collect()}
    assert got == {"ok": ("PASS", 0), "bad": ("FAIL", 1), "wrong": ("ERROR", None), "expr": ("FAIL", 1)}
    with pytest.raises(ValueError, match="bad: FAIL"):
        quality.stop_on_failure(out)


def test_contract(frame):
    rule = quality.Contract({"line": "numeric", "kind": None}, {"kind": ("a", "b")})
    with pytest.raises(quality.ContractViolation, match="line"):
        quality.contract(frame("kind string", ("a",)), rule, "feed")
    with pytest.raises(quality.ContractViolation, match="wrong type: line"):
        quality.contract(frame("kind string, line string", ("a", "1")), rule, "feed")
    warned = quality.contract(frame("kind string, line double", ("a", 1.0), ("z", 1.0)), rule, "feed").collect()
    assert [(r["column_name"], r["value"], r["rows"]) for r in warned] == [("kind", "z", 1)]


def test_zones(frame):
    df = quality.with_zone(frame("a int, b int, c int", (1, 1, 1)), {"b": 3, "c": (2, 24)})
    with pytest.raises(ValueError, match="72 h before the event: b, c"):
        quality.assert_leakage_safe(df, 72)
    quality.assert_leakage_safe(df.drop("b"), 24)
    assert marts.drop_zone(df, 3).columns == ["a", "c"]


def test_source_registry(spark):
    out = quality.source_registry(
        spark,
        [{"source_category": "odds", "source_name": "x", "enabled": True, "markets_available": ["spread", "total"], "reliability_score": 0.9}],
    ).first()
    assert (out["markets_available"], out["coverage_end"], out["enabled"]) == ("spread,total", None, True)


# --- evaluation ------------------------------------------------------------------------------


def test_regression_metrics_by_hand(frame):
    df = frame("a double, p double", (1.0, 2.0), (3.0, 2.0), (8.0, 6.0), (4.0, None))
    got = evaluate.regression(df, "a", "p").first()
    a, r = np.array([1.0, 3.0, 8.0, 4.0]), np.array([-1.0, 1.0, 2.0])
    assert got["n"] == 3 and np.isclose(got["rmse"], np.sqrt((r**2).mean())) and np.isclose(got["bias"], r.mean())
    assert np.isclose(got["r2"], 1 - (r**2).sum() / ((a - a.mean()) ** 2).sum())


def test_calibration_bins_are_right_closed(frame):
    df = frame("a int, p double", (0, 0.0), (1, 0.1), (1, 0.10001), (0, 1.0))
    got = {r["bin"]: r["n"] for r in evaluate.calibration(df, "a", "p").collect()}
    assert got == {1: 2, 2: 1, 10: 1}


def test_no_bet_is_not_a_loss(frame):
    df = frame(
        "m double, line double, pa double, pb double",
        (5.0, 3.0, 0.7, 0.3), (1.0, 3.0, 0.7, 0.3), (1.0, 3.0, 0.3, 0.7), (3.0, 3.0, 0.7, 0.3), (9.0, 3.0, 0.5, 0.5),
    )
    got = evaluate.ledger(df, "m", "line", "pa", "pb", edge=0.1).first().asDict()
    assert (got["n_games"], got["n_bets"], got["n_won"], got["n_lost"], got["n_push"], got["n_no_bet"]) == (5, 3, 2, 1, 1, 1)
    assert got["profit"] == 90.0 and np.isclose(got["roi"], 90 / 330)


def test_report_builds_every_part(spark):
    rng = np.random.default_rng(1)
    data = [
        (i, 2015 + i % 5, float(rng.normal() * 10), float(rng.normal() * 10), int(rng.random() < 0.5), float(rng.random()), float(rng.normal()), float(rng.normal()))
        for i in range(200)
    ]
    df = spark.createDataFrame(data, "id int, season int, a double, p double, w int, q double, o double, c double")
    df = df.withColumn("q2", 1 - F.col("q"))
    out = evaluate.report(
        df, regressions={"spread": ("a", "p")}, classifications={"win": ("w", "q")}, segments={"parity": F.col("id") % 2},
        period="season", line="o", spread=("a", "o", "q", "q2"), total=("a", "o", "q", "q2"), lines=("p", "o", "c"), tie=["id"],
    )
    assert {k: v.count() for k, v in out.items()}["segments"] == 3
    assert all(v.count() > 0 for v in out.values())


# --- scenarios -------------------------------------------------------------------------------


def test_summary_equals_expanded_draws(spark):
    ids = [3, 12345678901, -7, 2**31]
    df = spark.createDataFrame([(i, 2.5, 44.0) for i in ids], "id long, m double, t double")
    summary = {r["id"]: r for r in scenario.summarise(df, "id", "m", "t", F.lit(-3.0), F.lit(45.0), n=400, seed=9).collect()}
    draws = scenario.expand(df, "id", "m", "t", n=400, seed=9).groupBy("id").agg(
        F.avg((F.col("margin") > 0).cast("int")).alias("p"), F.avg((F.col("margin") > 3).cast("int")).alias("cover"),
        F.avg((F.col("points") > 45).cast("int")).alias("over"), F.expr("percentile(margin, 0.25)").alias("q"),
        F.stddev_samp("margin").alias("sd"), F.min("home_points").alias("low"), F.count("*").alias("n"),
    )
    for r in draws.collect():
        s = summary[r["id"]]
        assert r["n"] == 400 and r["low"] >= 0
        assert np.allclose([r["p"], r["cover"], r["over"], r["q"], r["sd"]], [s["p_home_win"], s["p_home_cover"], s["p_over"], s["margin_p25"], s["margin_sim_sd"]])


def test_draws_look_normal(spark):
    df = spark.range(50).select("id", F.lit(0.0).alias("m"), F.lit(400.0).alias("t"))
    draws = scenario.expand(df, "id", "m", "t", n=2000)
    z = np.array([r[0] for r in draws.select(F.col("margin") / scenario.MARGIN_SD).collect()])
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1) < 0.02
    for x, p in ((-1.645, 0.05), (0.0, 0.5), (1.96, 0.975)):
        assert abs((z < x).mean() - p) < 0.01


def test_missing_lines_and_predictions(spark):
    df = spark.createDataFrame([(1, 1.0, 44.0, None), (2, None, 44.0, -3.0)], "id long, m double, t double, s double")
    got = {r["id"]: r for r in scenario.with_ev(scenario.summarise(df, "id", "m", "t", "s", n=50)).collect()}
    assert got[1]["p_home_cover"] is None and got[1]["p_over"] is None and got[1]["p_home_win"] is not None
    assert got[2]["p_home_win"] is None and got[2]["ev_spread_home"] is None
    assert got[1]["n_sims"] == 50


def test_dashboard(frame, rows):
    df = frame("id int, name string, season int, team string, week int, pts double", (1, "Ann", 2020, "x", 1, 30.0), (1, "Ann", 2021, "y", 1, 30.0), (2, "Bob", 2020, "x", 1, 10.0))
    out = dash.entities(df, None, "id", ["name"], "season", "team", "pts")
    assert rows(out) == [(1, "Ann", 2021, 2020, "y", 60.0)]
    career = dash.career(df, ["season"], "week", {"pts": F.sum("pts"), "per": dash.share(F.sum("pts"), F.count_distinct("week"), 1)}, entity=F.col("id") == 1)
    assert rows(career) == [(2020, 1, 30.0, 30.0), (2021, 1, 30.0, 30.0)]
    assert rows(dash.career_summary(career, [], "pts"))[0] == (2, 60.0, 30.0)
    assert rows(dash.search(df, "name", "AN").select("name").distinct()) == [("Ann",)]
    assert rows(dash.periods(df, "season")) == [(2021,), (2020,)]


def test_gbt_mart_is_worked_out_once(spark, monkeypatch):
    from leaksafe.operators import ml
    from leaksafe.plans import queries_reports

    i = F.col("id")
    rows = spark.range(600).groupBy(i.alias("o_orderkey")).agg(F.max(i).alias("n_lines")).withColumns({
        "season": F.lit(1995) + F.col("n_lines") % 7, "o_totalprice": F.col("n_lines") * 1.5, "outcome": F.col("n_lines") % 2,
        **{c: F.sin(F.col("n_lines")) for c in ("price_std", "rate_std", "rating_pre")}, "games_played": F.col("n_lines") % 5, "unused": F.lit("x"),
    })
    rows = rows.withColumn("split", F.when(F.col("season") < 1998, "train").when(F.col("season") < 2000, "validation").otherwise("test"))
    monkeypatch.setattr(queries_reports, "wide_mart", lambda *_: rows)
    plans, train = [], ml.train

    def few(a, b, *args):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for df in (a, b))
        assert "unused" not in a.columns
        return train(a, b, *args, max_iter=2)

    monkeypatch.setattr(ml, "train", few)
    out = queries_reports.gbt_scores(spark, "")
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 3 and not any("Aggregate" in p or "Exchange" in p for p in plans)
    assert sorted(r.o_orderkey for r in out.collect()) == [k for k in range(600) if 1995 + k % 7 >= 2000]
