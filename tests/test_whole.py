"""Queries return every row of their tables, compared with their SQL freed of its row filters."""

import datetime as dt
import os

import oracle
import pytest

from tidemark import plans
from tidemark.operators import candles

SF = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF)


ALL_BARS = ["asof_close", "candle_features", "candle_labels_textbook", "true_range_textbook", "range_rank", "candle_labels", "gap_swap", "price_text", "smoothed_range", "rs_series", "series_arrays"]


@pytest.mark.parametrize("name", ALL_BARS)
def test_no_row_filter(name):
    assert "DATE '199" not in SQL[name] and "%" not in SQL[name]


def test_asof_close_has_every_row_of_the_axis(spark, con):
    assert oracle.differences(spark, SF, QUERIES["asof_close"], SQL["asof_close"], con) == ""
    n = QUERIES["union_axis"](spark, SF).agg({"n": "sum"}).first()[0]
    assert QUERIES["asof_close"](spark, SF).count() == n


def test_range_is_ranked_over_the_smoothed_range_before_it(spark):
    """Ranges that stay at a tenth of the price, but double: the first double one is the largest, though the price doubles too."""
    price = [100.0] * 40 + [200.0]
    rows = spark.createDataFrame([("A", dt.date(2026, 1, 1) + dt.timedelta(i), p, p * 1.1, p, p, 1.0) for i, p in enumerate(price)], "code string, date date, open double, high double, low double, close double, volume double")
    got = candles.range_rank(candles.features(rows)).orderBy("date").collect()
    assert [r["q_sr"] is None for r in got] == [i < 20 for i in range(41)]
    assert got[-1]["q_sr"] == 1.0 and got[-2]["q_sr"] == 0.5 + 0.5 / 39


def test_perfect_order_of_25_75_200_has_streaks():
    """The smallest tables hold too few bars for a streak; the next size has some."""
    sf = "/root/testdata/sf0.01"
    assert "ROWS 199 PRECEDING" in SQL["perfect_order"]
    rows = oracle.connection(sf).execute(SQL["perfect_order"]).fetchall()
    assert any(r[1] for r in rows)


def test_flat_bars_have_no_shares_and_no_doji(spark):
    rows = spark.createDataFrame([("A", dt.date(2026, 1, i), 5.0, 5.0, 5.0, 5.0, 1.0) for i in (1, 2, 3)], "code string, date date, open double, high double, low double, close double, volume double")
    got = candles.labels(candles.range_rank(candles.features(rows))).orderBy("date").collect()
    assert [(r["br"], r["ur"], r["dr"]) for r in got] == [(None, None, None)] * 3
    assert [r["candle_labels"] for r in got] == ["", "INVALID_TR0", "INVALID_TR0"]


def test_jump_over_the_smoothed_range_is_a_suspected_action(spark):
    """Twenty bars of range 2, then an open 40 % above the last close: 20 times the smoothed range, and 97 % of the bar's true range."""
    bars = [(100.0, 101.0, 99.0, 100.0)] * 20 + [(140.0, 141.0, 139.5, 140.5)]
    rows = spark.createDataFrame([("A", dt.date(2026, 1, 1) + dt.timedelta(i), *b, 1.0) for i, b in enumerate(bars)], "code string, date date, open double, high double, low double, close double, volume double")
    got = candles.labels(candles.range_rank(candles.features(rows, textbook=True))).orderBy("date").collect()[-1]
    assert got["atr"] == pytest.approx(2.0) and got["gap_atr"] == pytest.approx(20.0)
    assert got["candle_labels"].split(",")[:3] == ["ACTION_SUSPECT", "GAP_DOMINANT", "RANGE_VERY_LARGE"]
