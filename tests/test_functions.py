"""Hand-computed values of column functions."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from leaksafe.functions import clocks, features, geo, odds
from leaksafe.operators import clean, horizons
from leaksafe.operators.marts import temporal_split


@pytest.fixture
def one(spark):
    def value(*columns):
        row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return value


def test_prices(one):
    lit = F.lit
    got = one(odds.to_decimal(lit(150)), F.round(odds.to_decimal(lit(-110)), 4), odds.to_decimal(lit(50)))
    assert got == (2.5, 1.9091, None)
    assert one(odds.implied_prob(lit(150)), F.round(odds.implied_prob(lit(-110)), 4), odds.implied_prob(lit(50))) == (0.4, 0.5238, None)
    fair = one(odds.remove_vig(lit(0.5238), lit(0.5238)))
    assert (fair.fair_a, fair.fair_b, round(fair.vig_pct, 2)) == (0.5, 0.5, 4.76)
    assert tuple(one(odds.side_totals(lit(45.0), lit(-3.0)))) == (24.0, 21.0)


def test_key_numbers(one):
    lit = F.lit
    assert one(odds.key_distance(lit(-4.0), [3, 6, 7, 10, 14])) == 1.0
    assert one(odds.crossed(lit(-2.5), lit(-3.5), [3]), odds.crossed(lit(-3.5), lit(-4.0), [3])) == (True, False)
    assert one(odds.crossed(lit(None).cast("double"), lit(-4.0), [3])) is False
    assert one(odds.crossed(lit(-2.5), lit(-3.0), [3])) is True  # closed on the arrival side


def test_movement(one):
    m = one(odds.movement(F.lit(-3.0), F.lit(1.5)))
    assert (m.move, m.abs_move, m.flip, m.volatility) == (4.5, 4.5, 1, 1.5)
    assert one(odds.movement(F.lit(0.25), F.lit(1.25))).volatility == 1.0


def test_expected_value(one):
    bet = one(odds.ev(F.lit(0.55), F.lit(-110)))
    assert (bet.profit_if_win, bet.ev, bet.roi, bet.edge_pct) == (90.91, 5.0, 0.05, 5.0)


@pytest.mark.parametrize(
    "hours, label",
    [(120.1, "open"), (120.0, "72h"), (72.0, "72h"), (24.0, "24h"), (6.0, "6h"), (1.0, "1h"), (0.0, "close")],
)
def test_horizon_edges(one, hours, label):
    assert one(horizons.bucket_expr(F.lit(hours))) == label


def test_scores(one):
    missing = F.lit(None).cast("double")
    parts = lambda v: [(v, 5, 2.5, 40), (v, 0, 20, 25)]
    assert one(features.capped_score(parts(missing), 100)) == 0.0
    assert one(features.capped_score(parts(missing), 100, null_policy="propagate")) is None
    assert one(features.capped_score(parts(F.lit(30.0)), 100)) == 65.0
    assert one(features.capped_score(parts(F.lit(30.0)), 50)) == 50.0
    assert one(features.capped_score(parts(F.lit(30.0)), 100, override=(F.lit(True), 0))) == 0.0


def test_rate_is_a_double(spark):
    from leaksafe.operators.events import Agg, rollup

    df = spark.createDataFrame([(1, True), (1, False), (1, False)], "k int, x boolean")
    out = rollup(df, ["k"], {"rate": Agg("rate", F.col("x"))})
    assert out.schema["rate"].dataType.simpleString() == "double"
    assert math.isclose(out.first()["rate"], 1 / 3, rel_tol=1e-15)


def test_outcomes(one):
    lit, none = F.lit, F.lit(None).cast("int")
    assert one(features.outcome_flag(lit(3), lit(1)), features.outcome_flag(lit(1), lit(3))) == (1, 0)
    assert one(features.outcome_flag(lit(20), lit(20)), features.outcome_flag(none, none)) == (None, None)
    assert one(features.cover_flag(lit(4), lit(-3)), features.cover_flag(lit(3), lit(-3)), features.cover_flag(lit(2), lit(-3))) == (1, None, 0)


def test_ratio_and_flag(one):
    none = F.lit(None).cast("int")
    assert one(features.ratio(F.lit(1), F.lit(4)), features.ratio(F.lit(1), F.lit(0)), features.ratio(F.lit(1), none)) == (0.25, None, None)
    assert one(features.flag(none > 1), features.available(none)) == (0, 0)


def test_buckets(one):
    cut = lambda v, **kw: features.bucketize(v, [10, 20], ["a", "b", "c"], **kw)
    assert one(cut(F.lit(9.9)), cut(F.lit(10)), cut(F.lit(20))) == ("a", "b", "c")
    assert one(cut(F.lit(10), closed="right")) == "a"
    assert one(cut(F.lit(None).cast("int"), otherwise="?")) == "?"
    assert one(cut(F.lit(5), first=(F.lit(True), "dome"))) == "dome"
    with pytest.raises(ValueError):
        features.bucketize(F.lit(1), [1], ["a"])


def test_haversine(one):
    # A quarter of the equator.
    assert math.isclose(one(geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))), 6371 * math.pi / 2, rel_tol=1e-12)


def test_clocks(one):
    day = F.lit(dt.date(2024, 9, 8))
    assert one(clocks.at_clock(day, F.lit("16:25"))) == dt.datetime(2024, 9, 8, 16, 25)
    assert one(clocks.at_clock(day, F.lit("late"))) is None
    summer, winter = F.lit("2024-07-01 12:00:00").cast("timestamp"), F.lit("2024-12-01 12:00:00").cast("timestamp")
    assert one(clocks.utc_offset_hours(F.lit("America/New_York"), summer), clocks.utc_offset_hours(F.lit("America/New_York"), winter)) == (-4.0, -5.0)
    assert one(clocks.utc_offset_hours(F.lit("Asia/Kolkata"), summer)) == 5.5
    assert one(clocks.local_to_utc(F.lit("2024-09-08 13:00:00").cast("timestamp"), F.lit("America/New_York"))).hour == 17


def test_codes(frame, rows):
    df = frame("id int, c string", (1, "OAK"), (2, "SEA"), (3, None))
    assert [r[1] for r in rows(clean.remap(df, "c", {"OAK": "LV"}), "id")] == ["LV", "SEA", None]
    assert [r[1] for r in rows(clean.remap(df, "c", {"OAK": "LV"}, "other"), "id")] == ["LV", "other", None]
    assert [r[1] for r in rows(clean.exclude(df, "c", ["SEA"]), "id")] == ["OAK", None]
    assert [r[1] for r in rows(clean.exclude(df, "c", ["SEA"], keep_null=False), "id")] == ["OAK"]
    named = clean.standardise(df, "c", [("^oak$", "LV"), ("s.a", "XX")])
    assert [r[1] for r in rows(named, "id")] == ["LV", "XX", None]
    levels = clean.ordinal(df, "c", {"oak": 2}, out="n")
    assert [r[2] for r in rows(levels, "id")] == [2, 0, 0]


def test_safe_projection(frame, rows):
    df = frame("id int, x string", (1, "7"), (2, "seven"), (3, None))
    out = clean.project(df, {"id": "id", "x": ("x", "int", -1)}, safe=True)
    assert rows(out, "id") == [(1, 7), (2, -1), (3, -1)]


def test_split(frame, rows):
    df = frame("s int", (2014,), (2015,), (2019,), (2020,))
    labels = [r[1] for r in rows(df.withColumn("l", temporal_split("s", 2015, 2019)), "s")]
    assert labels == ["train", "validation", "validation", "test"]
