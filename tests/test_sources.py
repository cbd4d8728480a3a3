"""Tables, payloads, streams and the relation runner."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leaksafe.operators.quality import ODDS, ContractViolation, contract
from leaksafe.plans.catalog import Catalog, Relation, build, run
from leaksafe.sources import payloads, tables
from leaksafe.streaming import snapshots


def test_partitions_to_refresh():
    assert tables.partitions_to_refresh([], range(2020, 2024), [2023]) == [2020, 2021, 2022, 2023]
    assert tables.partitions_to_refresh([2020, 2021, 2023], range(2020, 2024), [2023]) == [2022, 2023]
    assert tables.partitions_to_refresh([2020], [2020, 2021], [2021], force=True) == [2020, 2021]
    assert tables.resolve_periods("2021:current", 2023) == [2021, 2022, 2023]
    assert tables.resolve_periods(2020, 2023) == [2020]


def test_write_replaces_only_touched_partitions(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame("season int, v int", (2022, 1), (2023, 1), (2023, 2)), path, partition=["season"])
    tables.write_table(frame("season int, v int", (2023, 9)), path, partition=["season"], files_per_partition=2)
    assert rows(tables.read_table(spark, path).select("season", "v"), "season") == [(2022, 1), (2023, 9)]
    assert tables.existing_partitions(spark, path, "season") == [2022, 2023]
    assert tables.existing_partitions(spark, str(tmp_path / "none"), "season") == []
    pruned = tables.read_table(spark, path, where="season = 2022")
    assert "PartitionFilters: [isnotnull(season" in pruned._jdf.queryExecution().executedPlan().toString()


def test_unsorted_rows_land_in_their_partition(spark, frame, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame("season int, v int", (2023, 2023), (2021, 2021), (2022, 2022)), path, partition=["season"])
    assert all(s == v for s, v in rows(tables.read_table(spark, path).select("season", "v")))


def test_union_by_name_and_casts(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame("season long, a int", (2020, 1)).write.parquet(path + "/season_dir=1")
    frame("season long, b int", (2021, 2)).write.parquet(path + "/season_dir=2")
    df = tables.register(spark, "both", path)
    assert set(df.columns) >= {"a", "b", "season"} and dict(df.dtypes)["season"] == "int"
    assert spark.table("both").count() == 2
    assert tables.register_all(spark, {"both2": path, "absent": str(tmp_path / "none")}) == ["both2"]


def test_stub(spark, frame, tmp_path):
    stub = tables.read_or_stub(spark, str(tmp_path / "none"), "game_id string, line double")
    assert stub.count() == 0 and stub.dtypes == [("game_id", "string"), ("line", "double")]
    frame("game_id string", ("g",)).write.parquet(str(tmp_path / "some"))
    assert tables.read_or_stub(spark, str(tmp_path / "some"), "game_id string, line double").first()[1] is None


def test_lineage_hash_is_stable(frame):
    df = frame("a int, b string", (1, "x"), (1, "x"), (1, "y"))
    out = tables.with_lineage(df, "src", "csv", ts=dt.datetime(2024, 1, 1)).collect()
    assert out[0]["row_hash"] == out[1]["row_hash"] != out[2]["row_hash"]
    assert (out[0]["source_name"], out[0]["source_file_type"], out[0]["source_version"]) == ("src", "csv", None)


def test_pending_and_external(frame, rows, tmp_path):
    wanted, have = frame("k string, d int", ("a", 1), ("a", 1), ("b", 2)), frame("k string, d int", ("a", 1))
    assert rows(tables.pending_keys(wanted, have, ["k", "d"])) == [("b", 2)]
    with pytest.raises(ContractViolation, match="season"):
        payloads.ingest_external(wanted, ["k", "season"])
    payloads.ingest_external(wanted.withColumn("season", F.lit(2020)), ["k"], str(tmp_path / "x"))


def test_kinds_do_not_overwrite_each_other(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    for kind in ("passing", "rushing"):
        df = frame("season int, stat_type string, v int", (2020, kind, 1))
        payloads.load_partitions(df, path, "stats", "parquet", partition=["season", "stat_type"])
    assert {r["stat_type"] for r in spark.read.parquet(path).collect()} == {"passing", "rushing"}


def test_csv(spark, tmp_path):
    (tmp_path / "s.csv").write_text("stadium_id,season_start,latitude\nA,2000,1.5\n")
    df = payloads.csv_table(spark, str(tmp_path / "s.csv"), "stadium_id string, season_start int, latitude double")
    assert tuple(df.first()) == ("A", 2000, 1.5)


RULES = [("kansas city|chiefs", "KC"), ("bills", "BUF")]


def test_odds_payload(frame, rows):
    event = {
        "id": "e1", "commence_time": "2024-09-08T17:00:00Z", "home_team": "Kansas City Chiefs", "away_team": "Buffalo Bills",
        "bookmakers": [
            {
                "key": "b1", "last_update": "2024-09-07T10:00:00Z",
                "markets": [
                    {"key": "spreads", "outcomes": [{"name": "Kansas City Chiefs", "price": -110, "point": -3.5}, {"name": "Buffalo Bills", "price": -110, "point": 3.5}]},
                    {"key": "totals", "outcomes": [{"name": "Over", "price": 100, "point": 47.5}]},
                    {"key": "h2h", "outcomes": [{"name": "Buffalo Bills", "price": 150}]},
                ],
            }
        ],
    }
    df = frame("payload string, fetched_at timestamp", (json.dumps([event]), dt.datetime(2024, 9, 7, 11)))
    out = payloads.odds_payload(df, "payload", RULES)
    got = rows(out.select("home_team", "away_team", "market_type", "selection", "line", "price_decimal"), "market_type", "selection")
    assert got == [
        ("KC", "BUF", "moneyline", "away", None, 2.5), ("KC", "BUF", "spread", "away", 3.5, got[1][5]),
        ("KC", "BUF", "spread", "home", -3.5, got[1][5]), ("KC", "BUF", "total", "over", 47.5, 2.0),
    ]
    ready = out.withColumns({"source_name": F.lit("api"), "ingestion_ts": F.current_timestamp()})
    assert contract(ready, ODDS, "api").count() == 0


def test_alternating_lines(frame, rows):
    df = frame(
        "n int, date string, team string, open string, close string",
        (1, "9/8/2024", "Bills", "47", "48.5"), (2, "9/8/2024", "Chiefs", "-3", "-3.5"), (3, "9/9/2024", "Bills", "44", "44"),
    )
    out = payloads.alternating_lines(df, "n", 2024, RULES)
    got = rows(out.select("event_id", "market_type", "selection", "snapshot_type", "line", "overunder_line"), "market_type", "snapshot_type")
    event = "2024_20240908_KC_BUF"
    assert got == [
        (event, "spread", "home", "closing", -3.5, 48.5), (event, "spread", "home", "opening", -3.0, 48.5),
        (event, "total", "over", "closing", 48.5, 48.5), (event, "total", "over", "opening", 47.0, 48.5),
    ]


def test_game_lines(frame, rows):
    df = frame(
        "game_id string, season int, week int, gameday date, home_team string, away_team string, spread_line double, home_spread_odds int, "
        "over_under_line double, spread_line_last_updated_at timestamp, over_under_last_updated_at timestamp",
        ("g", 2024, 1, dt.date(2024, 9, 8), "Chiefs", "Bills", -3.0, -105, 47.5, dt.datetime(2024, 9, 8), dt.datetime(2024, 9, 8)),
    )
    out = payloads.game_lines(df, RULES)
    assert rows(out.select("market_type", "selection", "line", "price_american", "home_team"), "market_type") == [
        ("spread", "home", -3.0, -105, "KC"), ("total", "over", 47.5, -110, "KC")
    ]


def test_hourly_payload(frame, rows):
    payload = json.dumps({"hourly": {"time": ["2024-09-08T17:00", "2024-09-08T18:00"], "temperature_2m": [70.5, 71], "precipitation": [25.4, None], "weather_code": [3, 61]}})
    df = frame("stadium_id string, payload string", ("A", payload))
    out = payloads.hourly_payload(df, "payload", ["stadium_id"], "forecast", precipitation_unit="mm")
    got = rows(out.select("observation_or_forecast_ts", "temperature_2m", "precipitation", "weather_code", "wind_speed_10m"), "observation_or_forecast_ts")
    assert got[0][1:] == (70.5, 1.0, 3, None) and got[1][1:] == (71.0, None, 61, None)


def test_snapshots_are_appended_once(frame):
    old = frame("k string, t int, v int", ("a", 1, 1))
    new = frame("k string, t int, v int", ("a", 1, 5), ("a", 2, 6), ("a", 2, 6))
    assert [tuple(r) for r in payloads.append_snapshots(new, old, ["k", "t"]).collect()] == [("a", 2, 6)]


# --- refresh by content --------------------------------------------------------------------


def test_refresh_writes_changed_partitions_only(spark, frame, tmp_path):
    """Order, files and NULLs do not matter, repeats and moved values do; partitions that are not given stay."""
    path = str(tmp_path / "t")
    schema = "k int, v string, w double, p int"
    data = [(i, None if i % 5 == 0 else f"v{i}", i / 3, i % 6) for i in range(60)]
    report = lambda rows: {r["p"]: (r["status"], r["rows"]) for r in tables.refresh_changed(frame(schema, *rows).repartition(3), path, ["p"]).collect()}
    files = lambda: {p: sorted(f.name for f in (tmp_path / "t" / f"p={p}").glob("*.parquet")) for p in range(6)}
    assert report(data) == {p: ("new", 10) for p in range(6)}
    before = files()
    assert report(list(reversed(data))) == {p: ("unchanged", 10) for p in range(6)} and files() == before
    moved = [(k, "" if v is None and p == 1 else v, w, p) for k, v, w, p in data if p != 2]  # a NULL becomes empty, partition 2 is not given
    moved += [r for r in data if r[3] == 3][:2] * 2 + [(99, None, None, None)]
    moved = [(k, v, w, p) if p != 4 else (k, v, data[(k + 6) % 60][2], p) for k, v, w, p in moved]  # values change places
    got = report(moved)
    assert got == {0: ("unchanged", 10), 1: ("rewritten", 10), 2: ("kept", 10), 3: ("rewritten", 14), 4: ("rewritten", 10), 5: ("unchanged", 10), None: ("new", 1)}
    assert {p for p in range(6) if files()[p] != before[p]} == {1, 3, 4}
    held = sorted(map(str, map(tuple, tables.read_table(spark, path).select("k", "v", "w", "p").collect())))
    assert held == sorted(map(str, moved + [r for r in data if r[3] == 2]))


def test_refresh_after_a_failure(spark, frame, tmp_path, monkeypatch):
    """Data are written before digests: what failed in between is written again. Without digests the rows tell."""
    path = str(tmp_path / "t")
    rows = [(i, i % 3) for i in range(30)]
    tables.refresh_changed(frame("k int, p int", *rows), path, ["p"])
    import shutil

    changed = [(k + (p == 1), p) for k, p in rows]
    write = tables.write_table

    def fail(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "write_table", fail)
    with pytest.raises(RuntimeError):
        tables.refresh_changed(frame("k int, p int", *changed), path, ["p"])
    monkeypatch.undo()
    status = lambda: {r["p"]: r["status"] for r in tables.refresh_changed(frame("k int, p int", *changed), path, ["p"]).collect()}
    assert status() == {0: "unchanged", 1: "rewritten", 2: "unchanged"}
    shutil.rmtree(path + ".digests")
    assert status() == dict.fromkeys(range(3), "unchanged")


def test_values_in_paths(spark):
    paths = spark.createDataFrame([("/a/season=2020/week=3/x.parquet",), ("season=1999/x",), ("/a/preseason=7/x",), ("/a/season=abc/x",), (None,)], "p string")
    out = paths.select(tables.path_part("season", "int", F.col("p")).alias("s"), tables.path_part("week", path=F.col("p")).alias("w"))
    assert [tuple(r) for r in out.collect()] == [(2020, "3"), (1999, None), (None, None), (None, None), (None, None)]


# --- streams ---------------------------------------------------------------------------------


@pytest.fixture
def feed(spark, frame, tmp_path):
    """Two polls that overlap, as two files."""
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    schema = "k string, book string, ts timestamp, v double"
    polls = [[("a", "x", at(1), 1.0), ("a", "y", at(2), 3.0)], [("a", "y", at(2), 3.0), ("b", "x", at(3), 5.0), ("a", "x", at(20), 7.0)]]
    path = str(tmp_path / "feed")
    for poll in polls:
        frame(schema, *poll).coalesce(1).write.mode("append").parquet(path)
    return path, schema


def test_dedup_across_batches(spark, feed, tmp_path):
    path, schema = feed
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=1)
    out = str(tmp_path / "out")
    query = snapshots.append_new(stream, ["k", "book"], "ts", out, str(tmp_path / "cp"))
    assert snapshots.drain(query, lambda: snapshots.read_appended(spark, out, stream.schema)).count() == 4


@pytest.mark.parametrize("files", [1, 3])
def test_late_snapshots_are_kept(spark, tmp_path, files):
    """Two hundred snapshots over as many days in three files, the oldest last, then all of them again."""
    path = str(tmp_path / "feed")
    rows = spark.range(200).selectExpr("id AS k", "timestamp'2020-01-01' + make_dt_interval(cast(id AS int)) AS ts", "id / 7 AS v")
    for low, high in ((140, 200), (60, 140), (0, 60), (0, 200)):
        rows.filter((F.col("k") >= low) & (F.col("k") < high)).coalesce(1).write.mode("append").parquet(path)
    stream = snapshots.read_snapshots(spark, path, rows.schema, "ts", files_per_trigger=files)
    out = str(tmp_path / "out")
    query = snapshots.append_new(stream, ["k"], "ts", out, str(tmp_path / "cp"))
    got = snapshots.drain(query, lambda: snapshots.read_appended(spark, out, stream.schema))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in rows.collect())


@pytest.fixture
def days_feed(spark, tmp_path):
    """Twelve daily polls of 100 rows, each with the day before once more, and two polls of days long gone."""
    path = str(tmp_path / "feed")
    schema = "k int, book int, ts timestamp, v double, arrived timestamp"
    day = lambda d: spark.range(100).selectExpr(
        "cast(id % 7 AS int) AS k", "cast(id % 3 AS int) AS book", f"timestamp'2024-01-01' + make_dt_interval({d}, 0, cast(id AS int)) AS ts",
        f"id / 7.0 + {d} AS v",
    )
    polls = [day(d) if d == 0 else day(d).unionByName(day(d - 1)) for d in range(12)] + [day(-30).unionByName(day(3)), day(-31).unionByName(day(11))]
    for n, poll in enumerate(polls):
        poll = poll.withColumn("arrived", F.expr(f"timestamp'2024-01-01' + make_dt_interval({n}, 12)")).selectExpr(*[c.split()[0] for c in schema.split(", ")])
        poll.selectExpr("*").withColumn("v", F.col("v").cast("double")).coalesce(1).write.mode("append").parquet(path)
    return path, schema, polls


def test_dedup_reads_the_touched_days_only(spark, days_feed, tmp_path, monkeypatch):
    """The state stays bounded, rows on time are compared with nothing, late ones with their own days."""
    path, schema, _ = days_feed
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=1)
    out, read, held = str(tmp_path / "out"), [], snapshots.held_rows

    def spy(spark, fields, table, days, before):
        rows = held(spark, fields, table, days, before)
        read.append((int(before), days, len(rows.inputFiles())))
        return rows

    monkeypatch.setattr(snapshots, "held_rows", spy)
    query = snapshots.append_new(stream, ["k", "book"], "ts", out, str(tmp_path / "cp"), delay="2 days", arrived="arrived")
    got = snapshots.drain(query, lambda: snapshots.read_appended(spark, out, stream.schema))
    assert got.count() == got.dropDuplicates(["k", "book", "ts"]).count() == 14 * 100
    assert [(n, days) for n, days, _ in read] == [(12, ["2023-12-02", "2024-01-04"]), (13, ["2023-12-01"])]
    assert all(files <= 8 for _, _, files in read)  # what one batch wrote of a day
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) <= 6 * 100


def test_a_failed_batch_appends_once(spark, days_feed, tmp_path, monkeypatch):
    path, schema, _ = days_feed
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=2)
    out, calls, clean = str(tmp_path / "out"), [], snapshots.remove

    def fail_once(spark, paths):
        calls.append(paths)
        if len(calls) == 3:
            raise RuntimeError("lost")
        clean(spark, paths)

    monkeypatch.setattr(snapshots, "remove", fail_once)
    run = lambda: snapshots.append_new(stream, ["k", "book"], "ts", out, str(tmp_path / "cp"), delay="2 days", arrived="arrived")
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    got = snapshots.drain(run(), lambda: snapshots.read_appended(spark, out, stream.schema))
    assert got.count() == got.dropDuplicates(["k", "book", "ts"]).count() == 14 * 100


def test_consensus_windows(spark, feed, tmp_path):
    path, schema = feed
    out = str(tmp_path / "out")
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=1)
    parts = snapshots.consensus_parts(stream, ["k"], "ts", "10 minutes", "book", "v")
    query = snapshots.consensus_table(parts, ["k"], out, str(tmp_path / "cp"))
    rows = snapshots.drain(query, lambda: snapshots.read_consensus(spark, parts, ["k"], out)).collect()
    # The window that is still open is there too.
    assert {(r["k"], r["book_count"], r["line_max"]) for r in rows} == {("a", 2, 3.0), ("b", 1, 5.0), ("a", 1, 7.0)}


@pytest.mark.parametrize("fails", [0, 2, 5])
def test_late_rows_join_closed_windows(spark, days_feed, tmp_path, monkeypatch, fails):
    """State goes when a stretch closes, late rows are merged into folded days, a batch that fails halfway counts nothing twice."""
    path, schema, polls = days_feed
    out, calls, clean = str(tmp_path / "out"), [], snapshots.remove

    def failing(spark, paths):
        calls.append(paths)
        if len(calls) == fails:
            raise RuntimeError("lost")
        clean(spark, paths)

    monkeypatch.setattr(snapshots, "remove", failing)
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=1)
    parts = snapshots.consensus_parts(stream, ["k"], "ts", "1 hour", "book", "v", prob="v", delay="1 day", arrived="arrived")
    run = lambda: snapshots.consensus_table(parts, ["k"], out, str(tmp_path / "cp"))
    query = run()
    if fails:
        with pytest.raises(Exception, match="lost"):
            query.awaitTermination()
        query = run()
    got = snapshots.drain(query, lambda: snapshots.read_consensus(spark, parts, ["k"], out))
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) <= 6 * 7 * 2  # the groups of six stretches of arrival out of fourteen
    assert snapshots.folded(spark, out) > 0
    rows = polls[0]
    for poll in polls[1:]:
        rows = rows.unionByName(poll)
    want = rows.groupBy(F.window("ts", "1 hour").alias("w"), "k").agg(
        F.countDistinct("book"), F.round(F.avg("v"), 9), F.min("v"), F.max("v"), F.round(F.stddev_pop("v"), 9), F.round(F.avg("v"), 9)
    )
    cols = ["book_count", F.round("consensus_line", 9), "line_min", "line_max", F.round("line_stddev", 9), F.round("consensus_prob", 9)]
    same = lambda df: sorted(tuple(r) for r in df.collect())
    assert same(got.select("window_start", "k", *cols)) == same(want.select("w.start", "k", *want.columns[2:]))


def test_latest_writes_what_a_batch_brings(spark, tmp_path):
    """Batches of 1 % of the keys write about 1 % of the rows; buckets are merged by size and split as they grow."""
    path, out = str(tmp_path / "feed"), str(tmp_path / "out")
    n = 40_000
    rows = lambda keys, poll: keys.selectExpr("id AS k", f"timestamp'2020-01-01' + make_dt_interval({poll}) AS ts", f"id * 100 + {poll} AS v")
    rows(spark.range(n), 50).coalesce(1).write.mode("append").parquet(path)
    rows(spark.range(n), 3).coalesce(1).write.mode("append").parquet(path)  # late: nothing of it stays
    for poll in range(60, 66):
        start = (poll - 60) * n // 100
        rows(spark.range(start, start + n // 100), poll).coalesce(1).write.mode("append").parquet(path)
    stream = snapshots.read_snapshots(spark, path, "k long, ts timestamp, v long", "ts", files_per_trigger=1)
    query = snapshots.latest_per_key(stream, ["k"], "ts", out, str(tmp_path / "cp"), bucket_bytes=60_000)
    read = lambda: snapshots.read_latest(spark, out, stream.schema, ["k"], "ts")
    got = {r["k"]: r["v"] for r in snapshots.drain(query, read).collect()}
    assert got == {k: k * 100 + (60 + k // (n // 100) if k < 6 * n // 100 else 50) for k in range(n)}
    parts = snapshots._parts(spark, out)
    assert {b.split("_")[0] for b in parts} == {"4"} and len(parts) == 16  # 8 buckets were too large
    count = lambda p: sum(spark.read.parquet(f"{out}/__bucket={b}/__part={p}").count() for b in parts if p in parts[b])
    assert count("m0000000001") == n
    for batch in range(2, 8):
        assert count(f"d{batch:010d}") == n // 100 and count(f"m{batch:010d}") == 0


def test_buckets_of_any_depth(spark):
    assert snapshots.leaves([], 1) == ["1_0", "1_1"]
    assert snapshots.leaves(["1_0", "2_1"], 1) == ["1_0", "2_1", "2_3"]  # 1_1 was split, one half has no rows yet
    assert snapshots.leaves(["1_0", "1_1", "3_1", "2_3"], 1) == ["1_0", "2_3", "3_1", "3_5"]  # a left-over parent gets no rows
    rows = spark.range(200).selectExpr("id", "xxhash64(id) AS __hash")
    for bits in (["1_0", "1_1"], ["1_0", "2_3", "3_1", "3_5"]):
        dealt = snapshots._dealt(rows, bits).collect()
        assert sorted(r["id"] for r in dealt) == list(range(200)) and {r["__bucket"] for r in dealt} == set(bits)


def test_latest_keeps_the_newest(spark, feed, tmp_path):
    path, schema = feed
    stream = snapshots.read_snapshots(spark, path, schema, "ts", files_per_trigger=1)
    stream = stream.withColumn("cutoff", F.lit("2024-01-01 00:10:00").cast("timestamp"))
    out = str(tmp_path / "out")
    query = snapshots.latest_per_key(stream, ["k"], "ts", out, str(tmp_path / "cp"), cutoff="cutoff", tie=["book"])
    got = snapshots.drain(query, lambda: snapshots.read_latest(spark, out, stream.schema, ["k"], "ts", ["book"]))
    assert sorted((r["k"], r["v"]) for r in got.collect()) == [("a", 3.0), ("b", 5.0)]


# --- runner ----------------------------------------------------------------------------------


def test_order_and_failure(spark, frame, tmp_path):
    catalog = Catalog()

    @catalog.relation("raw", materialise=True, partition=("season",))
    def stg(raw):
        return raw.filter("v > 0")

    @catalog.relation("stg")
    def broken(stg):
        return stg.select("missing")

    @catalog.relation("broken")
    def after(broken):
        return broken

    @catalog.relation("stg")
    def fine(stg):
        return stg.groupBy("season").count()

    assert catalog.order(["after"]).index("stg") < catalog.order(["after"]).index("broken")
    raw = frame("season int, v int", (2020, 1), (2021, 1), (2021, 0))
    frames, status = run(spark, catalog, {"raw": raw}, str(tmp_path))
    assert {r["name"]: r["status"] for r in status.collect()} == {"stg": "OK", "broken": "ERROR", "after": "SKIPPED", "fine": "OK"}
    assert spark.table("fine").count() == 2 and frames["fine"].count() == 2
    # An incremental run rebuilds one period and leaves the others.
    run(spark, catalog, {"raw": frame("season int, v int", (2020, 9), (2021, 5))}, str(tmp_path), targets=["stg"], period=("season", 2021))
    assert sorted((r["season"], r["v"]) for r in spark.read.parquet(str(tmp_path / "stg")).collect()) == [(2020, 1), (2021, 5)]
    assert build(catalog, {"raw": raw}, ["fine"])["fine"].count() == 2


def test_missing_source(spark, tmp_path):
    catalog = Catalog([Relation("x", ("nowhere",), lambda n: n)])
    _, status = run(spark, catalog, {}, str(tmp_path))
    assert {r["name"]: r["status"] for r in status.collect()} == {"nowhere": "MISSING", "x": "SKIPPED"}
