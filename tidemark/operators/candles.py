"""Candle features, price-limit lookup and label algebra."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Daily price limits; (price below, limit).
LIMITS = [
    (100, 30), (200, 50), (500, 80), (700, 100), (1000, 150), (1500, 300), (2000, 400), (3000, 500), (5000, 700), (7000, 1000),
    (10000, 1500), (15000, 3000), (20000, 4000), (30000, 5000), (50000, 7000), (70000, 10000), (100000, 15000), (150000, 30000),
    (200000, 40000), (300000, 50000), (500000, 70000), (700000, 100000), (1000000, 150000), (1500000, 300000), (2000000, 400000),
    (3000000, 500000), (5000000, 700000), (7000000, 1000000), (10000000, 1500000), (15000000, 3000000), (20000000, 4000000),
    (30000000, 5000000), (50000000, 7000000), (None, 10000000),
]


def limit_range(price: Column) -> Column:
    """Step lookup: limit of the first threshold above the price, as one ``CASE`` inside codegen (no join)."""
    out = None
    for top, limit in LIMITS:
        if top is None:
            return out.when(price.isNotNull(), F.lit(float(limit)))
        out = F.when(price < top, F.lit(float(limit))) if out is None else out.when(price < top, F.lit(float(limit)))
    return out


def features(bars: DataFrame, textbook: bool = False, frame: bool = False) -> DataFrame:
    """Range shares, direction and extremes of each bar.

    By default a bar is seen as the daily run of its own day sees it, as the
    last one: true range = high - low and no gap, whatever bars follow;
    ``textbook`` uses the previous close.  ``frame`` gives the features that
    one run has of all its bars: the previous close is shifted back by one, so
    every bar but the last has a gap, to its own close.  Labels are those of a
    run's last bar and take the default.
    """
    w = Window.partitionBy("code").orderBy("date")
    prev = F.lag("close", 1).over(w)
    x = prev if textbook else F.when(F.lead(F.lit(1)).over(w).isNotNull(), F.col("close")) if frame else F.lit(None).cast("double")
    rows = bars.withColumns({"prev_close": prev, "prev_high": F.lag("high", 1).over(w), "prev_low": F.lag("low", 1).over(w), "x": x, "k": F.row_number().over(w)})
    rows = rows.withColumn("tr", F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("x")), F.abs(F.col("low") - F.col("x"))))
    body, up, down = F.abs(F.col("close") - F.col("open")), F.col("high") - F.greatest("open", "close"), F.least("open", "close") - F.col("low")
    share = lambda c: c / F.nullif("tr", F.lit(0.0))  # noqa: E731  (null on bars without a range)
    return rows.withColumns({
        "direction": F.signum(F.col("close") - F.col("open")).cast("int"),
        "br": share(body), "ur": share(up), "dr": share(down),
        "gap": F.col("open") - F.col("x"),
        "close_pos": F.when(F.col("high") > F.col("low"), (F.col("close") - F.col("low")) / (F.col("high") - F.col("low"))),
        "hit_high": (F.col("close") == F.col("high")).cast("int"), "hit_low": (F.col("close") == F.col("low")).cast("int"),
    }).drop("x")


def smoothed_range(rows: DataFrame, span: int = 14) -> DataFrame:
    """Per instrument: exponentially smoothed true range before its last bar (recursion in date order, no Python)."""
    alpha = 2.0 / (span + 1)
    seq = F.transform(F.array_sort(F.collect_list(F.struct("date", "tr"))), lambda s: s["tr"])
    agg = rows.where("tr is not null").groupBy("code").agg(seq.alias("trs"))
    body = F.slice("trs", 1, F.size("trs") - 1)
    return agg.select("code", F.when(F.size("trs") > 1, F.aggregate(F.slice(body, 2, F.greatest(F.size(body), F.lit(1))), F.get(body, F.lit(0)), lambda e, x: F.lit(alpha) * x + F.lit(1 - alpha) * e)).alias("atr"))


def range_rank(rows: DataFrame, window: int = 252, span: int = 14) -> DataFrame:
    """Adds ``atr`` (smoothed true range up to the bar before), ``gap_atr`` (gap over it) and ``q_sr``.

    ``q_sr`` is the average-tie share of the last ``window`` ranges, each over
    its own prior smoothed range, that are not above the current one; null
    with fewer than min(20, window / 4) of them.  The recursion runs in date
    order over one Arrow table per instrument (bounded by its days).
    """

    def run(bars: pa.Table) -> pa.Table:
        bars = bars.sort_by("date")
        tr, gap = (bars[c].to_pandas().astype("float64") for c in ("tr", "gap"))
        atr = tr.ewm(span=span, adjust=False).mean().shift(1)
        base = atr.where(atr != 0)
        rank = (tr / base).rolling(window, min_periods=min(20, window // 4)).rank(pct=True)
        for name, values in (("atr", atr), ("gap_atr", gap.abs() / base), ("q_sr", rank)):
            bars = bars.append_column(name, pa.array(values, pa.float64(), from_pandas=True))
        return bars

    added = [T.StructField(c, T.DoubleType()) for c in ("atr", "gap_atr", "q_sr")]
    return rows.groupBy("code").applyInArrow(run, T.StructType([*rows.schema.fields, *added]))


def limit_label(prev: str = "prev_close") -> Column:
    """Touch, stuck and open-only labels at the day's limits; later checks win."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))  # noqa: E741
    r = limit_range(F.col(prev))
    hi, lo = F.col(prev) + r, F.col(prev) - r
    return (
        F.when((h <= lo) & (o <= lo) & (c <= lo) & (l <= lo), "LIMIT_LOW_FULL_STUCK")
        .when((h >= hi) & (o >= hi) & (c >= hi) & (l >= hi), "LIMIT_HIGH_FULL_STUCK")
        .when((l <= lo) & (o <= lo) & (c > lo), "LIMIT_LOW_OPEN_ONLY")
        .when((h >= hi) & (o >= hi) & (c < hi), "LIMIT_HIGH_OPEN_ONLY")
        .when((l <= lo) & (c <= lo), "LIMIT_LOW_TOUCH_STUCK")
        .when((h >= hi) & (c >= hi), "LIMIT_HIGH_TOUCH_STUCK")
        .when(l <= lo, "LIMIT_LOW_TOUCH")
        .when(h >= hi, "LIMIT_HIGH_TOUCH")
    )


def labels(rows: DataFrame) -> DataFrame:
    """Adds ``candle_labels`` to ``range_rank`` rows, comma-joined: limit, validity, action, dominant gap, size, body, wick, direction, window."""
    limit = limit_label()
    q, br, ur, dr = (F.col(x) for x in ("q_sr", "br", "ur", "dr"))
    size = F.when(q >= 0.95, "RANGE_VERY_LARGE").when(q >= 0.85, "RANGE_LARGE").when(q < 0.15, "RANGE_VERY_SMALL").when(q < 0.40, "RANGE_SMALL")
    doji = br <= 0.10
    body = F.when(doji, "DOJI").when(br >= 0.70, F.when(F.greatest(ur, dr) <= 0.15, "BODY_MARUBOZU_LIKE")).when(br >= 0.55, "BODY_LONG").when(br <= 0.25, "BODY_SMALL").when(br.isNotNull(), "BODY_MIDDLE")
    wick = (
        F.when((ur >= 0.45) & (dr >= 0.45), "WICK_BOTH_LONG").when((ur >= 0.25) & (dr >= 0.25), "WICK_BOTH_PRESENT").when(ur >= 0.45, "WICK_UPPER_LONG").when(dr >= 0.45, "WICK_LOWER_LONG").when(ur >= 0.25, "WICK_UPPER_PRESENT").when(dr >= 0.25, "WICK_LOWER_PRESENT")
    )
    way = F.when(~F.coalesce(doji, F.lit(False)), F.when(F.col("direction") > 0, "DIR_BULL").when(F.col("direction") < 0, "DIR_BEAR"))
    window = F.when(F.col("prev_high") < F.col("low"), "GAP_UP").when(F.col("prev_low") > F.col("high"), "GAP_DOWN")
    invalid = F.when((F.col("tr") == 0) & limit.isNull(), "INVALID_TR0")
    near = F.nullif(F.col("open") - F.col("gap"), F.lit(0.0))
    action = F.when((F.col("gap_atr") >= 5) | (F.col("gap_atr").isNotNull() & (F.abs(F.col("gap") / near) >= 0.30)), "ACTION_SUSPECT")
    dominant = F.when((F.col("gap_atr") >= 1.0) & (F.col("tr") > 0) & (F.abs("gap") / F.col("tr") >= 0.6), "GAP_DOMINANT")
    found = F.array_join(F.array_compact(F.array(limit, invalid, action, dominant, size, body, wick, way, window)), ",")
    return rows.withColumn("candle_labels", F.when(F.col("k") < 2, "").otherwise(found))


def swap_gap_tokens(labels_col: Column) -> Column:
    """Exchanges up and down window tokens; both at once is an error."""
    parts = F.split(labels_col, ",")
    both = F.array_contains(parts, "GAP_UP") & F.array_contains(parts, "GAP_DOWN")
    other = F.transform(parts, lambda t: F.when(t == "GAP_UP", "GAP_DOWN").when(t == "GAP_DOWN", "GAP_UP").otherwise(t))
    return F.when(both, F.raise_error(F.lit("both window tokens"))).otherwise(F.array_join(other, ","))


# Texts of the labels; the first that is present of each part.
LIMIT_TEXTS = [
    ("LIMIT_HIGH_TOUCH", "S高タッチ疑い"), ("LIMIT_LOW_TOUCH", "S安タッチ疑い"), ("LIMIT_HIGH_TOUCH_STUCK", "S高タッチ後張付き疑い"), ("LIMIT_LOW_TOUCH_STUCK", "S安タッチ後張付き疑い"),
    ("LIMIT_HIGH_OPEN_ONLY", "S高寄天疑い"), ("LIMIT_LOW_OPEN_ONLY", "S安寄底疑い"), ("LIMIT_HIGH_FULL_STUCK", "S高完全張り付き疑い"), ("LIMIT_LOW_FULL_STUCK", "S安完全張り付き疑い"),
]
ALONE_TEXTS = [("INVALID_TR0", "レンジ0"), ("INVALID_NAN", "判定不能"), ("ACTION_SUSPECT", "構造要因疑い"), ("SPLIT_CONFIRMED", "分割明示")]
PART_TEXTS = [
    [("GAP_DOMINANT", "ギャップ主導")],
    [("GAP_UP", "上窓＋"), ("GAP_DOWN", "下窓＋")],
    [("RANGE_VERY_LARGE", "<極大>"), ("RANGE_LARGE", "<大>"), ("RANGE_SMALL", "<小>"), ("RANGE_VERY_SMALL", "<極小>")],
    [("WICK_BOTH_LONG", "長上下ヒゲ"), ("WICK_BOTH_PRESENT", "上下ヒゲ"), ("WICK_UPPER_LONG", "長上ヒゲ"), ("WICK_LOWER_LONG", "長下ヒゲ"), ("WICK_UPPER_PRESENT", "上ヒゲ"), ("WICK_LOWER_PRESENT", "下ヒゲ")],
    [("DOJI", "十字線"), ("BODY_MARUBOZU_LIKE", "丸坊主"), ("BODY_LONG", "長"), ("BODY_SMALL", "短"), ("BODY_MIDDLE", "中")],
    [("DIR_BULL", "陽線"), ("DIR_BEAR", "陰線")],
]


def price_text(labels_col: Column) -> Column:
    """Text of a label list: a limit or an anomaly stands alone, the other parts follow one another."""
    parts = F.split(labels_col, ",")

    def first(options: list[tuple[str, str]]) -> Column:
        out = None
        for label, words in options:
            hit = F.array_contains(parts, label)
            out = F.when(hit, words) if out is None else out.when(hit, words)
        return out

    way = F.when(~F.array_contains(parts, "DOJI"), first(PART_TEXTS[-1]))
    joined = F.concat(*[F.coalesce(first(p), F.lit("")) for p in PART_TEXTS[:-1]], F.coalesce(way, F.lit("")))
    return F.coalesce(first(LIMIT_TEXTS + ALONE_TEXTS), joined)
