"""Ordered windows: plain path, hot keys in blocks, against pandas."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leaksafe.operators import asof, evaluate, rolling, schedule
from leaksafe.operators.ratings import affine_rating
from leaksafe.operators.windows import Frame, Running, global_rank, ordered, profile

OUTPUTS = {
    "n": Running("count", None, inclusive=True),
    "total": Running("sum", "v"),
    "mean": Running("avg", "v"),
    "low": Running("min", "v", inclusive=True),
    "high": Running("max", "v"),
    "seen": Running("last", "w", inclusive=True),
    "l5": Frame("avg", "v", -5, -1),
    "s4": Frame("sum", "v", -3, 0),
    "prev": Frame("first", "v", -1, -1),
    "next": Frame("first", "v", 1, 1),
}


@pytest.fixture(scope="module")
def events(spark):
    rng = np.random.default_rng(3)
    n = 3000
    # One key holds a third of the rows, and another third has no key at all.
    key = np.where(np.arange(n) % 3 == 0, 1.0, np.where(np.arange(n) % 3 == 1, np.nan, rng.integers(2, 60, n)))
    pdf = pd.DataFrame(
        {
            "id": np.arange(n), "k": pd.array(np.where(np.isnan(key), 0, key), dtype="int64"), "t": rng.integers(0, 400, n),
            "v": rng.normal(size=n).round(3), "w": np.where(rng.random(n) < 0.7, np.nan, rng.random(n)),
        }
    )
    pdf["k"] = [None if np.isnan(x) else int(x) for x in key]
    rows = [
        (int(r.id), None if r.k is None or r.k != r.k else int(r.k), int(r.t), float(r.v), None if r.w != r.w else float(r.w))
        for r in pdf.itertuples()
    ]
    return spark.createDataFrame(rows, "id long, k long, t long, v double, w double").cache()


def _pandas(df, *cols):
    return df.select("id", *cols).toPandas().sort_values("id").reset_index(drop=True)


def test_every_hot_key_is_cut(spark):
    """Three hundred keys above the limit, one of them with far more blocks than the others."""
    df = spark.range(300 * 40 + 4000).select(
        F.when(F.col("id") < 12000, F.col("id") % 300).otherwise(7).alias("k"), F.col("id"), (F.col("id") % 11).cast("double").alias("v")
    )
    hot = profile(df, ["k"], ["id"], rows_per_task=20)
    assert hot.fine.select("k").distinct().count() == 300
    assert hot.fine.where("k = 7").count() > 100 and hot.coarse.where("k = 7").count() > 8
    outputs = {"n": Running("count", None, inclusive=True), "total": Running("sum", "v"), "next": Frame("first", "v", 1, 1)}
    plain = ordered(df, ["k"], ["id"], outputs)
    cut = ordered(df, ["k"], ["id"], outputs, hot=hot)
    pd.testing.assert_frame_equal(_pandas(plain, *outputs), _pandas(cut, *outputs), check_dtype=False)


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("descending", [False, True])
def test_blocks_equal_plain(events, keys, descending):
    plain = ordered(events, keys, ["t", "id"], OUTPUTS, descending=descending)
    cut = ordered(events, keys, ["t", "id"], OUTPUTS, descending=descending, rows_per_task=64)
    pd.testing.assert_frame_equal(_pandas(plain, *OUTPUTS), _pandas(cut, *OUTPUTS), check_dtype=False)
    assert cut.columns == plain.columns


def test_hot_key_is_split(events):
    hot = profile(events, ["k"], ["t", "id"], rows_per_task=64)
    sizes = {r["k"]: r["count"] for r in hot.fine.groupBy("k").count().collect()}
    assert sizes[1] >= 10 and sizes[None] >= 10
    assert all(k in (1, None) for k in sizes)


def test_plain_equals_pandas(events):
    got = _pandas(ordered(events, ["k"], ["t", "id"], {"mean": OUTPUTS["mean"], "l5": OUTPUTS["l5"]}), "mean", "l5")
    pdf = events.toPandas().sort_values(["t", "id"])
    groups = pdf.groupby("k", dropna=False)["v"]
    want = pd.DataFrame({"id": pdf["id"]})
    want["mean"] = groups.transform(lambda s: s.expanding().mean().shift(1))
    want["l5"] = groups.transform(lambda s: s.rolling(5, min_periods=1).mean().shift(1))
    want = want.sort_values("id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_no_hot_key_is_one_shuffle(events):
    df = ordered(events, ["k"], ["t", "id"], OUTPUTS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "Join" not in plan


def test_lagged_mean_fixture(frame, rows):
    df = frame("e string, p int, t int, x double", ("a", 1, 1, 1.0), ("a", 1, 2, 2.0), ("a", 1, 3, 3.0))
    out = rolling.lagged(df, ["e", "p"], ["t"], ["x"], {"std": None})
    assert rows(out.select("x_std", "games_played"), "games_played") == [(None, 0), (1.0, 1), (1.5, 2)]


def test_last_two_fixture(frame, rows):
    df = frame("e string, t int, x double", *[("a", i, float(i)) for i in range(1, 5)])
    out = rolling.lagged(df, ["e"], ["t"], ["x"], {"l2": 2})
    assert rows(out.select("t", "x_l2"), "t") == [(1, None), (2, 1.0), (3, 1.5), (4, 2.5)]


def test_blend_fixture(frame, rows):
    df = frame("c double, p double, n int", (1.0, 2.0, 2), (1.0, 2.0, 3), (1.0, None, 2), (1.0, None, 3))
    out = df.select(F.round(rolling.blend_prior("c", "p", "n"), 6))
    assert [r[0] for r in rows(out)] == [2.0, 1.3, 0.0, 0.7]


def test_future_does_not_leak(spark, events):
    """Changing the value of late rows leaves the features of rows up to them alone."""
    late = F.col("t") >= 200
    changed = events.withColumn("v", F.when(late, F.col("v") + 1000).otherwise(F.col("v")))
    names = ["v_std", "v_l3"]
    one, two = (
        rolling.lagged(df, ["k"], ["t", "id"], ["v"], {"std": None, "l3": 3}).filter(F.col("t") < 200) for df in (events, changed)
    )
    pd.testing.assert_frame_equal(_pandas(one, *names), _pandas(two, *names))


def test_partition_count_does_not_matter(spark, events):
    def run():
        return _pandas(rolling.lagged(events, ["k"], ["t", "id"], ["v"], {"std": None}), "v_std")

    eight = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    pd.testing.assert_frame_equal(eight, one)


def _recursion(games, k=20.0, init=1500.0, hfa=65.0, revert=0.33):
    out, prev, last = [], None, None
    for season, outcome, home in games:
        start = init if prev is None else prev
        pre = start if prev is None or season <= last else start + revert * (init - start)
        edge = hfa if prev is None or home == 1 else -hfa
        if outcome is None:
            post = start
        else:
            post = pre + k * (outcome - 1 / (1 + 10 ** (-edge / 400)))
        out.append((pre, post))
        prev, last = post, season
    return out


@pytest.mark.parametrize("rows_per_task", [None, 10])
def test_rating_equals_recursion(spark, rows_per_task):
    rng = np.random.default_rng(5)
    data, want = [], {}
    for e in range(6):
        games = [(2000 + i // 17, None if rng.random() < 0.1 else int(rng.random() < 0.5), int(rng.random() < 0.5)) for i in range(150)]
        want[e] = _recursion(games)
        data += [(e, i, s, o, h) for i, (s, o, h) in enumerate(games)]
    df = spark.createDataFrame(data, "e long, i long, season int, outcome int, home int")
    hot = profile(df, ["e", "season"], ["i"], rows_per_task=rows_per_task)
    assert (hot.fine is not None) == (rows_per_task is not None)
    out = affine_rating(df, ["e"], ["i"], "season", "outcome", "home", hot=hot)
    for r in out.collect():
        pre, post = want[r["e"]][r["i"]]
        assert abs(r["rating_pre"] - pre) < 1e-8 and abs(r["rating_post"] - post) < 1e-8
        assert r["rating_seq"] == r["i"] + 1
    assert out.schema["rating_post"].metadata["zone"] == 3


@pytest.mark.parametrize("revert", [0.0, 0.33, 0.9, 1.0])
def test_rating_over_a_long_history(spark, revert):
    """One period per row, far beyond where the product of the reversions leaves the range of a double."""
    rng = np.random.default_rng(8)
    n = 5000
    data = [("a", i, i, None if rng.random() < 0.05 else int(rng.random() < 0.5), int(rng.random() < 0.5)) for i in range(n)]
    df = spark.createDataFrame(data, "e string, i long, s long, o int, h int")
    got = affine_rating(df, ["e"], ["i"], "s", "o", "h", revert=revert).orderBy("i").select("rating_pre", "rating_post").collect()
    want = _recursion([(s, o, h) for _, _, s, o, h in data], revert=revert)
    assert max(abs(g[k] - w[k]) for g, w in zip(got, want) for k in (0, 1)) < 1e-6


def test_rating_fixtures(frame, rows):
    df = frame("e string, i int, s int, o int, h int", ("a", 1, 1, 1, 0))
    out = affine_rating(df, ["e"], ["i"], "s", "o", "h").select("rating_pre", F.round("rating_post", 2))
    assert rows(out) == [(1500.0, 1508.15)]


def test_schedule(frame, rows):
    df = frame(
        "e string, d date, f int",
        *[("a", d, f) for d, f in [(__import__("datetime").date(2024, 1, x), f) for x, f in ((1, 1), (5, 1), (20, 0), (27, 1), (28, 1))]],
    )
    out = schedule.gaps(df, ["e"], ["d"], "d")
    got = rows(out.select("days_since_last", "opener_flag", "short_gap_flag", "long_gap_flag", "days_until_next"), "d")
    assert got == [(None, 1, 0, 0, 4), (4, 0, 1, 0, 15), (15, 0, 0, 1, 7), (7, 0, 0, 0, 1), (1, 0, 1, 0, None)]
    assert out.schema["days_until_next"].metadata["zone"] == 3
    assert [r[0] for r in rows(schedule.streak(df, ["e"], ["d"], "f").orderBy("d").select("streak"))] == [0, 1, 2, 0, 1]
    counts = schedule.recent_counts(df, ["e"], ["d"], "f", n=2, out="c").orderBy("d").select("c")
    assert [r[0] for r in rows(counts)] == [1, 2, 1, 1, 2]


def _brute(left, right, choose):
    out = []
    for l in left:
        options = [r for r in right if r[0] == l[1] and l[1] is not None and choose(l, r) is not None]
        best = min(options, key=lambda r: choose(l, r)) if options else None
        out.append((l[0], best[2] if best else None))
    return sorted(out)


@pytest.fixture(scope="module")
def two_lines(spark):
    rng = np.random.default_rng(11)
    left = [(i, None if i % 17 == 0 else int(rng.integers(0, 4)), int(rng.integers(0, 300))) for i in range(300)]
    right = [(int(rng.integers(0, 3)), int(rng.integers(0, 300)), j) for j in range(400)]
    make = lambda t: F.timestamp_seconds(F.col(t) * 60)
    l = spark.createDataFrame(left, "id long, k long, at long").withColumn("at", make("at"))
    r = spark.createDataFrame(right, "k long, ts long, rid long").withColumn("ts", make("ts"))
    return left, right, l.cache(), r.cache()


@pytest.mark.parametrize("strict", [True, False])
@pytest.mark.parametrize("rows_per_task", [None, 25])
def test_latest_before_equals_brute_force(two_lines, strict, rows_per_task, monkeypatch):
    from leaksafe.operators import windows

    left, right, l, r = two_lines
    if rows_per_task:
        monkeypatch.setattr(windows, "ROWS_PER_TASK", rows_per_task)
    out = asof.latest_before(l, r, ["k"], "at", "ts", "rid", strict=strict, cols=["rid"])
    want = _brute(
        left, right, lambda a, b: (-b[1], -b[2]) if (b[1] < a[2] if strict else b[1] <= a[2]) else None
    )
    assert sorted((x["id"], x["rid"]) for x in out.collect()) == want


@pytest.mark.parametrize("rows_per_task", [None, 25])
def test_nearest_equals_brute_force(two_lines, rows_per_task, monkeypatch):
    from leaksafe.operators import windows

    left, right, l, r = two_lines
    if rows_per_task:
        monkeypatch.setattr(windows, "ROWS_PER_TASK", rows_per_task)
    out = asof.nearest(l, r, ["k"], "at", "ts", "rid", cols=["rid"])
    want = _brute(left, right, lambda a, b: (abs(b[1] - a[2]), b[1], -b[2]))
    assert sorted((x["id"], x["rid"]) for x in out.collect()) == want


def test_safe_forecast_fixture(spark):
    ts = lambda h: F.timestamp_seconds(F.lit(h * 3600))
    runs = [(run, target, run * 10 + i) for run in (1, 2, 3) for i, target in enumerate((9, 11))]
    right = spark.createDataFrame(runs, "run long, target long, rid long").select(
        F.lit("a").alias("k"), F.timestamp_seconds(F.col("run") * 3600).alias("run"),
        F.timestamp_seconds(F.col("target") * 3600 + 60).alias("target"), "rid",
    )
    left = spark.range(1).select(F.lit("a").alias("k"), ts(3).alias("cutoff"), ts(10).alias("at"))
    out = asof.latest_safe_forecast(left, right, ["k"], "cutoff", "run", "at", "target", "rid", ["rid"])
    assert [r["rid"] for r in out.collect()] == [20]  # run 2; 9:01 is 59 minutes away, 11:01 is 61


def test_first_and_last_ignore_missing_order(frame, rows):
    df = frame("k string, t int, v int", ("a", None, 9), ("a", 1, 1), ("a", 2, 2), ("b", None, 7))
    assert rows(asof.first_per_key(df, ["k"], "t", ["v"]), "k")[0] == ("a", 1, 1)
    assert rows(asof.last_per_key(df, ["k"], "t", ["v"]), "k")[0] == ("a", 2, 2)


@pytest.mark.parametrize("n", [0, 3, 501])
def test_tiles_equal_ntile(spark, n):
    rng = np.random.default_rng(2)
    # A third of all rows share one movement.
    data = [(i, float(rng.normal()), 3.0, 3.0 - (1.0 if i % 3 == 0 else float(rng.integers(0, 9)))) for i in range(n)]
    df = spark.createDataFrame(data, "id long, pred double, o double, c double")
    out = evaluate.line_value_tiles(df.repartition(5), "pred", "o", "c", ["id"])
    got = {r["movement_tile"]: (r["n"], round(r["mean_movement"], 9)) for r in out.collect()}
    sizes = sorted((abs(o - c), i) for i, _, o, c in data)
    tiles = np.array_split(np.array([s for s, _ in sizes]), 4)
    assert got == {i + 1: (len(t), round(float(t.mean()), 9)) for i, t in enumerate(tiles) if len(t)}


def test_global_rank_spreads_ties(spark):
    """Equal values lie in several ranges, and ranks have no gap."""
    df = spark.range(4000).selectExpr("id", "cast(if(id % 3 = 0, 5, id % 11) AS int) AS v")
    out = global_rank(df.repartition(6, "id"), ["v", "id"])
    rows = sorted(tuple(r) for r in out.collect())
    want = {i: k + 1 for k, (_, i) in enumerate(sorted((5 if i % 3 == 0 else i % 11, i) for i in range(4000)))}
    assert [(i, r, t) for i, _, r, t in rows] == [(i, want[i], 4000) for i in range(4000)]
    assert out.groupBy(F.spark_partition_id()).count().count() > 1


def test_safe_forecast_equals_brute_force(spark):
    """Ties, NULLs and repeated questions; one exchange of the facts, by key and run."""
    rng = np.random.default_rng(7)
    left = [(i, None if i % 13 == 0 else int(rng.integers(0, 4)), None if i % 17 == 0 else int(rng.integers(0, 40)), int(rng.integers(0, 60))) for i in range(300)]
    left += [(300 + i, 1, 20, 30) for i in range(200)]  # a third of all rows ask the same
    right = [(i, None if i % 19 == 0 else int(rng.integers(0, 4)), int(rng.integers(0, 40)) // 4 * 4, None if i % 23 == 0 else int(rng.integers(0, 60))) for i in range(400)]
    at = lambda c: F.timestamp_seconds(F.col(c) * 3600).alias(c)
    lefts = spark.createDataFrame(left, "id long, k long, cutoff long, at long").select("id", "k", at("cutoff"), at("at"))
    rights = spark.createDataFrame(right, "rid long, k long, run long, target long").select("rid", "k", at("run"), at("target"))
    out = asof.latest_safe_forecast(lefts, rights, ["k"], "cutoff", "run", "at", "target", "rid", ["rid"], prefix="f_")
    assert out.columns == ["id", "k", "cutoff", "at", "f_rid"]
    want = []
    for i, k, cutoff, when in left:
        runs = [r[2] for r in right if k is not None and r[1] == k and cutoff is not None and r[2] < cutoff]
        options = [r for r in right if runs and r[1] == k and r[2] == max(runs) and r[3] is not None]
        best = min(options, key=lambda r: (abs(r[3] - when), r[3], -r[0])) if options else None
        want.append((i, best[0] if best else None))
    assert sorted((r["id"], r["f_rid"]) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # Distinct runs, and the facts once.
    assert len(re.findall(r"Exchange hashpartitioning\(k#\d+L, __run#", plan)) == 2


