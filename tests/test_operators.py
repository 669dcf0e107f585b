"""Hand-checkable cases on tiny frames."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import calendar, candles, derived, events, grid, indicators, ops, universe
from tidemark.sources import sinks, tables

D = dt.date


def bars_of(spark, rows, code="x"):
    return spark.createDataFrame([(code, d, *map(float, v)) for d, v in rows], "code string, date date, open double, high double, low double, close double, volume double")


def closes(spark, rows, code="x"):
    return bars_of(spark, [(d, (c, c, c, c, 1)) for d, c in rows], code)


def bench_of(spark, rows, name="topix"):
    return spark.createDataFrame([(name, d, float(c)) for d, c in rows], "bench string, date date, close double")


def test_relative_strength_on_union_calendar(spark):
    stock = closes(spark, [(D(2026, 1, 1), 100), (D(2026, 1, 2), 102), (D(2026, 1, 6), 106), (D(2026, 1, 7), 108)])
    ref = bench_of(spark, [(D(2026, 1, d), c) for d, c in ((1, 100), (2, 101), (3, 102), (6, 103), (7, 104))])
    rs = indicators.relative_strength(calendar.with_asof(calendar.union_axis(stock, ref)), (2,))
    got = calendar.at_run_date(rs, "2026-01-07", ["code", "bench"]).first()["rs2"]
    assert got == pytest.approx((108 / 102 - 1) - (104 / 102 - 1))


def test_relative_strength_missing_start_is_null(spark):
    stock = closes(spark, [(D(2026, 1, 1), 100), (D(2026, 1, 2), 102)])
    ref = bench_of(spark, [(D(2026, 1, 1), 1), (D(2026, 1, 2), 1)])
    rs = indicators.relative_strength(calendar.with_asof(calendar.union_axis(stock, ref)), (31,))
    assert {r["rs31"] for r in rs.collect()} == {None}


def test_flat_turnover_has_ratio_but_no_score(spark):
    rows = closes(spark, [(D(2026, 1, 1) + dt.timedelta(i), 100) for i in range(30)])
    last = calendar.at_run_date(indicators.turnover_metrics(rows, 21), "2026-12-31", ["code"]).first()
    assert last["turnover_ma_ratio_21"] == pytest.approx(1.0) and last["z_turnover_21"] is None


def test_few_values_give_neither(spark):
    rows = spark.createDataFrame([("x", D(2026, 1, 1) + dt.timedelta(i), None if i < 24 else 5.0, 1.0) for i in range(25)], "code string, date date, close double, volume double")
    last = calendar.at_run_date(indicators.turnover_metrics(rows, 21), "2026-12-31", ["code"]).first()
    assert last["turnover_ma_ratio_21"] is None and last["z_turnover_21"] is None


@pytest.mark.parametrize(("bar", "token"), [((102, 103, 101, 102), "GAP_UP"), ((96, 97, 95, 96), "GAP_DOWN"), ((99, 101, 97, 100), None)])
def test_window_tokens(spark, bar, token):
    rows = bars_of(spark, [(D(2026, 1, 1), (99, 100, 98, 99, 1)), (D(2026, 1, 2), (*bar, 1))])
    got = candles.labels(candles.range_rank(candles.features(rows))).where("date = '2026-01-02'").first()["candle_labels"].split(",")
    assert [t for t in got if t.startswith("GAP_")] == ([token] if token else [])


def test_limit_steps(spark):
    df = spark.createDataFrame([(99.9,), (100.0,), (6e7,), (None,)], "p double").select(candles.limit_range(F.col("p")).alias("l"))
    assert [r["l"] for r in df.collect()] == [30.0, 50.0, 10000000.0, None]


@pytest.mark.parametrize(("values", "run", "want"), [([100 + i for i in range(40)], 39, 21), ([100] * 40, 39, 0), ([100 + i for i in range(10)], 9, None), ([100 + i for i in range(40)], 45, None)])
def test_perfect_order(spark, values, run, want):
    rows = closes(spark, [(D(2026, 1, 1) + dt.timedelta(i), v) for i, v in enumerate(values)])
    got = indicators.perfect_order_days(rows, str(D(2026, 1, 1) + dt.timedelta(run)), (5, 10, 20), 30).first()["perfect_order_days"]
    assert got == want


def test_information_ratio_needs_variation(spark):
    days = [(D(2026, 1, 1) + dt.timedelta(i), 100 * 1.01**i) for i in range(70)]
    got = indicators.information_ratio(calendar.union_axis(closes(spark, days), bench_of(spark, days)), "2026-12-31").first()["information_ratio"]
    assert got is None


def test_stale_with_enough_bars_is_not_ipo(spark):
    df = spark.createDataFrame([("stale", 300, 3e7), ("stale", 10, 3e7), ("ok", 300, None), ("ok", 300, 1e6), ("missing", 0, None), ("ok", 300, 3e7)], "s string, n int, m double")
    got = [r[0] for r in df.select(universe.segment(F.col("s"), F.col("n"), F.col("m"), 252, 2e7)).collect()]
    assert got == ["core", "ipo", "illiquid", "illiquid", "ipo", "core"]


def test_market_classes(spark):
    raw = ["プライム（内国株式）", "プライム（外国株式）", "ETF・ETN", "PRO Market", "出資証券", "", None, "x"]
    df = spark.createDataFrame([(r,) for r in raw], "r string").select(universe.classify_market(F.col("r")).alias("c"))
    assert [r["c"] for r in df.collect()] == ["equity_domestic", "equity_foreign", "etf_etn", "pro_market", "investment_securities", "unknown", "unknown", "unknown"]


def test_preview_keeps_ties_and_drops_nulls(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 1.0), ("e", None)], "k string, z double")
    assert {r["k"] for r in grid.preview(df, "z", 2).collect()} == {"a", "b", "c"}


def test_no_events_is_cause_c_and_future_scores_no_time(spark):
    ev = spark.createDataFrame([("1", 0, dt.datetime(2026, 2, 2), "earnings")], "code string, ordinal int, published_at timestamp, event_type string")
    ranked = events.rank_candidates(ev, "2026-02-01")
    assert ranked.first()["score_time"] == 0.0
    spikes = spark.createDataFrame([("2",)], "code string")
    row = events.summarise(spikes, ranked).first()
    assert (row["cause_type"], row["cause_score"]) == ("C", 0.0)


def test_dedup_prefers_source_then_confidence_then_arrival(spark):
    df = spark.createDataFrame([("a", 0, "k", 0.9), ("a", 1, "t", 0.1), ("b", 2, "k", 0.5), ("b", 3, "k", 0.5), ("b", 4, "k", 0.6)], "id string, o int, source string, conf double")
    got = events.dedup_with_preference(df, ["id"], F.col("source") == "t", "conf", "o")
    assert {r["id"]: r["o"] for r in got.collect()} == {"a": 1, "b": 4}


def test_rules(spark):
    df = spark.createDataFrame([("1", "4.2", "DOJI, GAP_UP_X"), ("2", "bad", "DOJI"), ("3", None, None)], "code string, z string, labels string")
    rules = [{"type": "z_turnover_gt", "column": "z", "value": 4.0}, {"type": "candle_labels_contains_any", "column": "labels", "values": ["gap_up"]}]
    assert [r["code"] for r in df.where(events.selection(rules, df.columns)).collect()] == ["1"]
    assert df.where(events.selection([], df.columns)).count() == 0


def test_codes_and_decimals(spark):
    df = spark.createDataFrame([("1",), (" Ab12 ",), ("72030",)], "c string")
    got = df.select(text.metric_code(F.col("c")).alias("m"), text.alias_code(F.col("c")).alias("a")).collect()
    assert [r["m"] for r in got] == ["0001", "Ab12", "72030"] and [r["a"] for r in got] == [None, "AB12", "7203"]
    nums = spark.createDataFrame([(1.23,), (-0.0,), (100.0,), (None,)], "x double").select(derived.decimal_text(F.col("x")).alias("t"))
    assert [r["t"] for r in nums.collect()] == ["1.23", "0", "100", None]


def test_decimals_round_the_exact_binary_value(spark):
    nums = spark.createDataFrame([(5e-11,), (1e22,), (0.1,), (float("inf"),), (float("nan"),)], "x double").select(derived.decimal_text(F.col("x")).alias("t"))
    assert [r["t"] for r in nums.collect()] == ["0.0000000001", "1" + "0" * 22, "0.1", None, None]


def test_alias_actions_follow_confidence_not_arrival(spark):
    rows = [("1", "k", "low", 9, "z", 1), ("1", "k", "high", 1, "y", 2), ("1", "m", "low", 1, "a", 3), ("1", "m", "low", 2, "b", 4), ("1", "n", "medium", 3, "B", 5), ("1", "n", "medium", 3, "a", 6), ("1", "o", "high", 1, "q", 7)]
    found = spark.createDataFrame(rows, "code string, dedup_key string, confidence string, seen_count long, alias string, ordinal long")
    known = spark.createDataFrame([("1", "o")], "code string, dedup_key string")
    got = {r["ordinal"]: r["action"] for r in ops.merge_aliases(known, found).collect()}
    assert got == {1: "skip", 2: "add", 3: "review", 4: "review", 5: "skip", 6: "add", 7: "skip"}


def test_titles_and_aliases_meet_in_one_form(spark):
    df = spark.createDataFrame([("Ａｂｃ（株） の決算", ["abc 株"]), ("other", ["abc"]), ("abc", [""])], "title string, name_aliases array<string>").withColumn("code", F.lit("1")).withColumn("ordinal", F.monotonically_increasing_id())
    rows = events.rank_candidates(df, "2026-01-01", "v2").orderBy("ordinal").collect()
    assert [r["score_name"] for r in rows] == [1.0, 0.0, 0.0]


def test_blank_labels_and_unknown_rules_select_nothing(spark):
    df = spark.createDataFrame([("GAP_UP",), (None,)], "candle_labels string")
    for rule in ({"type": "candle_labels_contains_any", "values": ["", " "]}, {"type": "other", "column": "candle_labels", "values": ["GAP"]}):
        assert df.where(events.selection([rule], df.columns)).count() == 0
    assert df.where(events.selection([{"type": "candle_labels_contains_any", "values": [" gap "]}], df.columns)).count() == 1


def test_flags(spark):
    df = spark.createDataFrame([(None, math.inf), (1.0, math.nan)], "a double, b double")
    rows = derived.snapshot_flags(df, ["a", "b"]).collect()
    assert rows[0]["_flags"]["missing_metrics"] == ["a"] and rows[0]["_flags"]["non_finite_metrics"] == ["b"] and rows[1]["b"] is None


def test_merge_and_upsert(spark):
    old = spark.createDataFrame([("a", D(2026, 1, 2), 1), ("b", D(2026, 1, 5), 1)], "k string, d date, v int")
    new = spark.createDataFrame([("a", D(2026, 1, 2), 2), ("b", D(2026, 1, 4), 2), ("c", D(2026, 1, 1), 2)], "k string, d date, v int")
    got = {r["k"]: r["v"] for r in derived.upsert_latest(old, new, ["k"], "d").collect()}
    assert got == {"a": 2, "b": 1, "c": 2}
    assert derived.merge_series(old, new, ["k", "d"], overwrite=False).where("k = 'a'").first()["v"] == 1


def test_pick_as_of_and_fallback(spark):
    rel = spark.createDataFrame([(D(2026, 1, 1), 1, 0), (D(2026, 2, 1), 2, 1), (D(2026, 2, 1), 3, 2)], "snapshot_date date, run_id int, ordinal int")
    assert universe.pick_as_of(rel, "2026-02-15").first()["run_id"] == 3
    assert universe.pick_as_of(rel, "2025-02-15").first()["picked"] == "fallback_latest"
    assert universe.pick_as_of(rel.limit(0), "2026-02-15").count() == 0


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "bars").mkdir()
    (tmp_path / "bars" / "264A.csv").write_text("﻿Date,Open,High,Low,Close,Volume\n2026-01-01,1,2,0.5,1.5,10\n2026-01-01,1,2,0.5,1.6,11\n2026-01-02T00:00:00+09:00,1,2,0.5,1.7,12\n", encoding="utf-8")
    got = sorted(tables.read_bars(spark, str(tmp_path / "bars")).collect(), key=lambda r: r["date"])
    assert [(r["code"], str(r["date"]), r["close"]) for r in got] == [("264A", "2026-01-01", 1.6), ("264A", "2026-01-02", 1.7)]
    (tmp_path / "m.jsonl").write_text('{"code": "1", "status": "ok"}\nbroken\n{"code": "1", "status": "stale"}\n')
    assert [r["status"] for r in tables.read_manifest(spark, str(tmp_path / "m.jsonl")).collect()] == ["stale"]
    (tmp_path / "e.jsonl").write_text('{"code": "1", "title": "t", "confidence_base": 0}\n{"code": " ", "title": "u"}\n')
    ev = tables.read_events(spark, str(tmp_path / "e.jsonl")).collect()
    assert len(ev) == 1 and ev[0]["confidence_base"] == 0.5 and ev[0]["event_type"] == "other"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    sinks.put_create_only(df, str(tmp_path / "o"))
    with pytest.raises(Exception):
        sinks.put_create_only(df, str(tmp_path / "o"))
    assert sinks.publish(df, str(tmp_path / "stage"), 1, ["k", "v"]) and not sinks.publish(df, str(tmp_path / "stage2"), 2, ["k", "v"])


def test_streams(spark, tmp_path):
    from tidemark.streaming import events as streaming

    src = str(tmp_path / "in")
    df = spark.createDataFrame([("a", 1, dt.datetime(2026, 1, 1, 1)), ("a", 2, dt.datetime(2026, 1, 1, 2)), ("b", 3, dt.datetime(2026, 1, 3))], "k string, v int, ts timestamp")
    df.coalesce(1).write.parquet(src)
    stream = streaming.stream_of(spark, src, df.schema)
    q = streaming.first_seen(stream, "ts", ["k"]).writeStream.format("memory").queryName("seen").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("seen").count() == 2
    sink = streaming.upsert_sink(str(tmp_path / "out"), ["k"], ["ts"])
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r["k"]: r["v"] for r in spark.read.parquet(str(tmp_path / "out") + "/v=0").collect()} == {"a": 2, "b": 3}


def test_ops(spark):
    runs = spark.createDataFrame([("w", "success", dt.datetime(2026, 1, 20)), ("w", "failed", dt.datetime(2026, 1, 21)), ("v", "running", dt.datetime(2026, 1, 1))], "workflow string, status string, started_at timestamp")
    got = {r["workflow"]: r["success_rate"] for r in ops.success_rates(runs, "2026-01-25").collect()}
    assert got == {"w": 0.5, "v": None}
    assert ops.stale_running(runs, ["v"], "2026-01-02").count() == 1


def test_decimal_of_exact_binary_value_and_fingerprint(spark):
    from tidemark.operators import rules

    df = spark.createDataFrame([(1.23,), (-0.0,), (1e-11,), (2.5,), (None,)], "x double").select(rules.exact_decimal(F.col("x")).alias("t"))
    assert [r["t"] for r in df.collect()] == ["1.23", "0", "0", "2.5", None]
    assert rules.json_fingerprint({"b": 1, "a": "é"}) == rules.json_fingerprint({"a": "é", "b": 1})


def test_action_and_dominant_gaps(spark):
    rows = bars_of(spark, [(D(2026, 1, 1), (99, 100, 98, 99, 1)), (D(2026, 1, 2), (140, 141, 139, 140, 1))])
    f = candles.range_rank(candles.features(rows, textbook=True)).withColumn("gap_atr", F.col("gap") / 2.0)
    got = candles.labels(f).where("date = '2026-01-02'").select("candle_labels", candles.price_text(F.col("candle_labels")).alias("t")).first()
    assert "ACTION_SUSPECT" in got["candle_labels"] and "GAP_DOMINANT" in got["candle_labels"] and got["t"] == "S高完全張り付き疑い"
