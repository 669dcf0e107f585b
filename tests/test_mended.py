"""Rules that were wrong once: candle labels, names in titles, digests, staged rows, selection values, site tables."""

import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import plans
from tidemark.functions import site_tables
from tidemark.operators import candles, derived, events, rules
from tidemark.sources import tables

SF = "/root/testdata/sf0.001"
BARS = "code string, date date, open double, high double, low double, close double, volume double"


def bars(spark, n):
    import random

    r, out, c = random.Random(2), [], 100.0
    for i in range(n):
        o = c * r.uniform(0.7, 1.4)
        c = o * r.uniform(0.8, 1.25)
        out.append(("A", dt.date(2026, 1, 1) + dt.timedelta(i), o, max(o, c) * 1.02, min(o, c) * 0.97, c, 1.0))
    return spark.createDataFrame(out, BARS)


def test_more_bars_change_no_earlier_label(spark):
    labels = lambda n: {r["date"]: r["candle_labels"] for r in candles.labels(candles.range_rank(candles.features(bars(spark, n)))).collect()}
    long = labels(60)
    for n in (2, 30, 59):
        assert all(long[d] == x for d, x in labels(n).items())
    assert not any("SUSPECT" in x or "DOMINANT" in x for x in long.values())


def test_in_a_frame_every_bar_but_the_last_has_a_gap(spark):
    """The previous close shifted back by one is the bar's own close, whatever the next one is; prices may be missing or out of range."""
    prices = [(10.0, 12.0, 9.0, 11.0), (11.0, 13.0, 10.0, None), (9.0, 10.0, 8.0, 14.0), (9.0, 10.0, 8.0, 14.0)]
    rows = spark.createDataFrame([("A", dt.date(2026, 1, 1 + i), *p, 1.0) for i, p in enumerate(prices)], BARS)
    got = candles.features(rows, frame=True).orderBy("date").collect()
    assert [r["gap"] for r in got] == [-1.0, None, -5.0, None]
    assert [r["tr"] for r in got] == [3.0, 3.0, 6.0, 2.0]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_candle_features_have_the_gaps_of_all_bars(spark):
    got = plans.queries()["candle_features"](spark, SF).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.count("gap").alias("gaps")).collect()
    assert got and all(r["gaps"] == r["n"] - 1 for r in got)


def test_gaps_of_a_frame_are_taken_over_the_smoothed_range_before_them(spark):
    """Ranges of 2: the smoothed range is 2 from the second bar on, and a gap of 1 is half of it; the first bar has none before it, the last no gap."""
    rows = spark.createDataFrame([("A", dt.date(2026, 1, 1 + i), 10.0, 12.0, 10.0, 11.0, 1.0) for i in range(4)], BARS)
    got = candles.range_rank(candles.features(rows, frame=True)).orderBy("date").collect()
    assert [r["gap_atr"] for r in got] == [None, 0.5, 0.5, None]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_range_rank_has_the_gaps_of_all_bars(spark):
    """Only a code's last bar has no gap, and only bars whose smoothed range before is missing or 0 have none over it."""
    base = candles.range_rank(candles.features(tables.bars(spark, SF))).select("code", "date", "atr", "k")
    got = plans.queries()["range_rank"](spark, SF).join(base, ["code", "date"]).withColumn("last", F.max("k").over(Window.partitionBy("code")) == F.col("k")).collect()
    assert got and all((r["gap_atr"] is not None) == (bool(r["atr"]) and not r["last"]) for r in got)
    assert any(r["gap_atr"] for r in got)


def test_names_meet_titles_in_compatibility_form(spark):
    df = spark.createDataFrame([("ｿﾆｰ、新製品", ["ソニー"]), ("ＡＢＣ（株） news", ["x", "abc株"]), ("abc", ["－", None, ""]), (None, ["a"]), ("a", None)], "t string, a array<string>")
    assert [r[0] for r in df.select(events.name_match(F.col("t"), F.col("a"))).collect()] == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_digest_rows_are_json(spark):
    df = spark.createDataFrame([('a"b\\', "é\u001f\n", 0.5)], "code string, s string, x double")
    row = rules.digest_rows(df, "code", {"s": "string", "x": "float"}).first()["row"]
    want = {"instrument_code": 'a"b\\', "values": [{"metric_key": "s", "type": "string", "value": "é\u001f\n"}, {"metric_key": "x", "type": "float", "value": "0.5"}], "flags": {"missing_metrics": [], "non_finite_metrics": [], "po_indeterminate": False}}
    assert row == json.dumps(want, ensure_ascii=False, separators=(",", ":"))
    payload = {"schema_version": 1, "trade_date": "2026-01-01", "metric_set_version_id": "s", "rows": [want]}
    digest = rules.logical_digest(rules.digest_rows(df, "code", {"s": "string", "x": "float"}), "2026-01-01", "S").first()["digest"]
    assert digest == hashlib.sha256(json.dumps(payload, ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


def test_a_staged_row_without_a_key_is_an_error(spark):
    df = spark.createDataFrame([(1, '[{"k":1,"v":2},{"k":null,"v":3}]')], "o int, p string")
    with pytest.raises(Exception, match="staged row without k"):
        derived.staged_rows(df, "p", "k:bigint,v:bigint", ["k"], "o").collect()


def test_rules_without_a_number_select_nothing(spark):
    df = spark.createDataFrame([(1.0,), (9.0,)], "z double")
    for value, n in (("abc", 0), (None, 0), (float("nan"), 0), ("3.5", 1), (3.5, 1)):
        assert df.where(events.selection([{"type": "z_turnover_gt", "column": "z", "value": value}], ["z"])).count() == n
    assert events.selection_rules(None) == events.selection_rules({"any_of": []}) == [{"type": "z_turnover_gt", "column": "z_turnover_60", "value": 3.5}]
    assert events.selection_rules({"any_of": [{"type": "x"}]}) == [{"type": "x"}]


def test_enrichment_of_titles_and_missing_candidates(spark):
    ind = spark.createDataFrame([("a",), (" B ",), ("c",), ("d",), ("e",), ("f",), (None,)], "code string")
    said = [("A", "A", "top", 1), ("b", "B", "", 1), ("c ", "", "top", 1), ("d", "a", "alone", 1), ("e", "A", "old", 0), ("e", "C", "new", 1)]
    found = [(" a", " ", "/1", "s", 1, 0.5, 1), ("A", "two", "/2", "t", 2, 0.4, 2), ("a", "three", "/3", "u", None, 0.9, 3), ("b", None, "/4", "s", 1, 0.1, 1), ("e", "x", "/5", "s", 1, 1.0, 1)]
    got = events.enrich(ind, spark.createDataFrame(said, "code string, cause_type string, top_title string, ordinal int"), spark.createDataFrame(found, "code string, title string, url string, source string, rank int, cause_score double, ordinal int"), 2)
    names = ("event_cause_type", "event_news_1_title", "event_news_1_url", "event_news_1_source", "event_news_2_title", "event_news_2_score")
    none = events.NO_CAUSE_TITLE
    want = {"a": ("A", "top", "/1", "s", "two", 0.4), " B ": ("C", none, "", "s", "", None), "c": ("C", none, "", "", "", None), "d": ("A", "alone", "", "", "", None), "e": ("C", none, "", "", "", None), "f": ("", "", "", "", "", None), None: ("", "", "", "", "", None)}
    assert {r["code"]: tuple(r[n] for n in names) for r in got.collect()} == want


PAGE = """<table><tr><th>t</th><th colspan="2">wide</th></tr>
<tr><td rowspan=2>one</td><td>a<table><tr><td>inner <b>x</b></td></tr></table>b</td><td><a href="/l">link</a></td></tr>
<tr><td colspan="oops">c</td><td>d</td></tr><tr><td>short</table><p>out</p><td>stray</td>"""


def test_tables_are_laid_out(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<table>")], "k long, h string")
    got = site_tables.page_tables(df, "k", "h").orderBy("k", "table", "row").collect()
    assert [(r["k"], r["table"], r["parent"], [c["text"] for c in r["cells"]]) for r in got] == [
        (1, 0, None, ["t", "wide", "wide"]), (1, 0, None, ["one", "a b", "link"]), (1, 0, None, ["one", "c", "d"]), (1, 0, None, ["short"]), (1, 1, 0, ["inner x"]),
    ]
    assert got[1]["cells"][2]["href"] == "/l" and got[0]["cells"][0]["header"]


def test_dates_of_the_sites(spark):
    df = spark.createDataFrame([("2026/1/5", "26/01/05 09:30"), ("2026-01-05", "26/01/05  23:59"), ("5/1", "26/13/05 09:30"), ("2026/02/30", "026/01/05 09:30"), (None, None), (" 2026/12/31 ", "x")], "a string, b string")
    got = df.select(site_tables.slash_date(F.col("a")).alias("a"), site_tables.news_time(F.col("b")).alias("b")).collect()
    assert [r["a"] for r in got] == [dt.date(2026, 1, 5)] * 2 + [None] * 3 + [dt.date(2026, 12, 31)]
    assert [r["b"] for r in got] == [dt.datetime(2026, 1, 5, 9, 30), dt.datetime(2026, 1, 5, 23, 59), None, None, None, None]


def test_pages_count_up_to_the_first_empty_one(spark):
    df = spark.createDataFrame([("a", p) for p in (1, 1, 2, 4, 5)] + [("b", 2)] + [("c", p) for p in range(1, 9)], "l string, p int")
    got = sorted((r["l"], r["p"]) for r in site_tables.until_empty(df, "l", "p", 5).collect())
    assert got == [("a", 1), ("a", 1), ("a", 2)] + [("c", p) for p in range(1, 6)]


def test_cutoffs_are_wall_clock_times(spark):
    df = spark.createDataFrame([("2026-03-06T15:30:00+09:00",), ("2026-03-06 15:30:01",), ("2026-03-06",), ("2026-03-06T15:29:59Z",), ("later",), (None,)], "t string")
    assert [r[0] for r in df.select(events.within_cutoff(F.col("t"), "2026-03-06", "15:30")).collect()] == [True, False, True, True, False, False]
    assert df.where(events.within_cutoff(F.col("t"), "2026-03-06", None)).count() == 6
    for bad in ("1530", "24:00", "15:60", "a:b", ""):
        with pytest.raises(ValueError):
            events.cutoff_time("2026-03-06", bad)


def test_categories_without_a_name_stay(spark):
    df = spark.createDataFrame([(" x ",), ("y",), (None,)], "c string")
    assert [r[0] for r in events.without_categories(df, "c", ["x", " "]).collect()] == ["y", None]
    assert events.without_categories(df, "c", []).count() == 3
