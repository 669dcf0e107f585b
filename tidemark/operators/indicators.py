"""Time-series indicators as windows over an instrument's own rows or a pair's union axis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.calendar import PAIR, anchored_return, pair_window, union_axis, with_asof, with_run_anchor

RS_WINDOWS = (31, 63, 126, 252)


def least_samples(n: int) -> int:
    """At least 20 samples, and seven tenths of the window."""
    return max(20, int(0.7 * n))


def turnover_metrics(bars: DataFrame, n: int = 60) -> DataFrame:
    """``z_turnover``, ``turnover_ma_ratio``, ``turnover_yen``, ``price_change_pct`` on the instrument's own rows."""
    w = Window.partitionBy("code").orderBy("date")
    last = w.rowsBetween(-(n - 1), 0)
    x, v = F.log1p(F.col("close") * F.col("volume")), F.col("close") * F.col("volume")
    rows = bars.withColumns({"x": x, "v": v}).withColumns({
        "k": F.row_number().over(w),
        "c": F.count("x").over(last),
        "m": F.avg("x").over(last),
        "sd": F.stddev_samp("x").over(last),
        "mv": F.avg("v").over(last),
        "before": F.lag("close", 1).over(w),
    })
    enough = (F.col("k") > n) & (F.col("c") >= least_samples(n)) & F.col("x").isNotNull()
    return rows.select(
        "code", "date", "close", "volume",
        F.col("v").alias("turnover_yen"),
        F.when(enough & (F.col("sd") > 0), (F.col("x") - F.col("m")) / F.col("sd")).alias(f"z_turnover_{n}"),
        F.when(enough & (F.col("mv") > 0), F.col("v") / F.col("mv")).alias(f"turnover_ma_ratio_{n}"),
        ((F.col("close") / F.nullif("before", F.lit(0.0)) - 1) * 100).alias("price_change_pct"),
        F.col("k").alias("n_bars_used"),
    )


def relative_strength(asof: DataFrame, windows: tuple[int, ...] = RS_WINDOWS) -> DataFrame:
    """Adds ``rs{T}``: the instrument's as-of return less the benchmark's, per axis date."""
    w = pair_window()
    return asof.withColumns({f"rs{t}": anchored_return("s", t, w) - anchored_return("b", t, w) for t in windows})


def rs_acceleration(rs: DataFrame, n: int = 60) -> DataFrame:
    """Adds ``rs_acceleration`` (short less long) and its z-score over the last ``n`` axis rows."""
    rows = rs.withColumn("rs_acceleration", F.col("rs31") - F.col("rs252"))
    last = pair_window().rowsBetween(-(n - 1), 0)
    a = "rs_acceleration"
    sd = F.stddev_samp(a).over(last)
    z = (F.last(a, True).over(last) - F.avg(a).over(last)) / sd
    return rows.withColumn("rs_acceleration_zscore", F.when((F.count(a).over(last) >= least_samples(n)) & (sd > 0), z))


def acceleration_at(rs: DataFrame, run_date: str, n: int = 60) -> DataFrame:
    """``rs_acceleration`` and its z-score at each pair's last axis row not after the run date: one aggregate of the ``n`` rows that end there, no sliding frames."""
    rows = with_run_anchor(rs.select(*PAIR, "date", "pos", (F.col("rs31") - F.col("rs252")).alias("a")), run_date)
    last = rows.where((F.col("pos") > F.col("p") - n) & (F.col("pos") <= F.col("p")))
    agg = last.groupBy(*PAIR).agg(F.count("a").alias("k"), F.avg("a").alias("m"), F.stddev_samp("a").alias("sd"), F.max_by("a", F.when(F.col("a").isNotNull(), F.col("pos"))).alias("now"), F.max(F.when(F.col("pos") == F.col("p"), F.col("a"))).alias("rs_acceleration"))
    z = F.when((F.col("k") >= least_samples(n)) & (F.col("sd") > 0), (F.col("now") - F.col("m")) / F.col("sd"))
    return agg.select(*PAIR, "rs_acceleration", z.alias("rs_acceleration_zscore"))


def slice_returns(axis: DataFrame, run_date: str, first: int, last: int) -> DataFrame:
    """Paired returns inside the axis slice ``p - first .. p - last``; filling and differencing never look outside it."""
    cut = with_run_anchor(axis, run_date).where((F.col("pos") >= F.col("p") - first) & (F.col("pos") <= F.col("p") - last))
    w = pair_window()
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    filled = cut.withColumns({"fs": F.last("stock_close", True).over(up), "fb": F.last("bench_close", True).over(up)})
    r = lambda c: F.col(c) / F.nullif(F.lag(c, 1).over(w), F.lit(0.0)) - 1
    return filled.select(*PAIR, "date", r("fs").alias("rs"), r("fb").alias("rb")).where("rs is not null and rb is not null")


def beta_adjusted(asof: DataFrame, run_date: str, window: int = 252, beta_window: int = 126) -> DataFrame:
    """Return over ``window`` less beta times the benchmark's; beta from the ``beta_window`` axis rows that end where it starts.

    Everything is a window or an aggregate on the pair's own partition: the
    beta slice's returns (filled inside the slice only) and the final returns
    meet in one aggregation, without a join.
    """
    w = pair_window()
    first, last = window + beta_window - 1, window
    rows = with_run_anchor(asof, run_date).withColumns({"r_s": anchored_return("s", window, w), "r_b": anchored_return("b", window, w)})
    inside = (F.col("pos") >= F.col("p") - first) & (F.col("pos") <= F.col("p") - last)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    part = lambda c: F.last(F.when(inside, F.col(c)), True).over(up)
    rows = rows.withColumns({"fs": F.when(inside, part("stock_close")), "fb": F.when(inside, part("bench_close"))})
    r = lambda c: F.col(c) / F.nullif(F.lag(c, 1).over(w), F.lit(0.0)) - 1
    rows = rows.withColumns({"rs": r("fs"), "rb": r("fb")})
    both = F.col("rs").isNotNull() & F.col("rb").isNotNull()
    agg = rows.groupBy(*PAIR).agg(
        F.count_if(both).alias("n"),
        F.covar_pop(F.when(both, F.col("rs")), F.when(both, F.col("rb"))).alias("cov"),
        F.var_pop(F.when(both, F.col("rb"))).alias("var"),
        F.max(F.when(F.col("pos") == F.col("p"), F.col("r_s"))).alias("r_s"),
        F.max(F.when(F.col("pos") == F.col("p"), F.col("r_b"))).alias("r_b"),
        F.max("p").alias("p"),
    )
    beta = F.when((F.col("n") >= least_samples(beta_window)) & (F.col("var") > 0), F.col("cov") / F.col("var"))
    return agg.where("p is not null").select(*PAIR, beta.alias("beta"), (F.col("r_s") - beta * F.col("r_b")).alias("beta_adjusted_rs"))


def information_ratio(axis: DataFrame, run_date: str, window: int = 63) -> DataFrame:
    """Mean over standard deviation of excess returns in the last ``window`` axis rows."""
    excess = slice_returns(axis, run_date, window - 1, 0).withColumn("e", F.col("rs") - F.col("rb"))
    agg = excess.groupBy(*PAIR).agg(F.count("e").alias("n"), F.avg("e").alias("m"), F.stddev_samp("e").alias("sd"))
    return agg.select(*PAIR, F.when((F.col("n") >= least_samples(window)) & (F.col("sd") > 0), F.col("m") / F.col("sd")).alias("information_ratio"))


def sma_relative_strength(axis: DataFrame, window: int = 75, t: int = 31) -> DataFrame:
    """RS of ``window``-row averages: a null inside a window voids it; the averages form their own axis."""
    w = pair_window()
    last = w.rowsBetween(-(window - 1), 0)
    sma = lambda c: F.when(F.count(c).over(last) == window, F.avg(c).over(last))
    rows = axis.select(*PAIR, "date", sma("stock_close").alias("ss"), sma("bench_close").alias("sb")).where("ss is not null or sb is not null")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"s": F.last("ss", True).over(up), "b": F.last("sb", True).over(up)})
    return rows.select(*PAIR, "date", (anchored_return("s", t, w) - anchored_return("b", t, w)).alias(f"rs_sma{window}"))


def own_average(rows: DataFrame, key: str, window: int = 75) -> DataFrame:
    """Average of the last ``window`` closes of a series' own rows, as its ``close``; rows with fewer, or a null among them, go."""
    last = Window.partitionBy(key).orderBy("date").rowsBetween(-(window - 1), 0)
    avg = F.when(F.count("close").over(last) == window, F.avg("close").over(last))
    return rows.select(key, "date", avg.alias("close")).where("close is not null")


def axis_day_metrics(bars: DataFrame, bench: DataFrame, axis: DataFrame, names: tuple[str, ...] = ("topix", "nikkei"), windows: tuple[int, ...] = RS_WINDOWS) -> DataFrame:
    """Every metric of every instrument on each day of ``axis``; days without a bar have a row of nulls.

    Turnover scores come from an instrument's own rows, relative strength, its
    acceleration and that one's score from the union axis, and the averaged
    relative strength from averages of each series' own rows, which form an
    axis of their own.  Each is computed over the whole history and cut to the
    axis (a list of sessions) before it moves; the cut rows meet by code and day.
    """
    days = axis.select("date").distinct()
    on_axis = lambda df: df.join(F.broadcast(days), "date", "left_semi")
    z = on_axis(turnover_metrics(bars)).select("code", "date", "z_turnover_60")
    rs = rs_acceleration(relative_strength(with_asof(union_axis(bars, bench)), windows))
    columns = [*[f"rs{t}" for t in windows], "rs_acceleration", "rs_acceleration_zscore"]
    wide = lambda df, cs: df.groupBy("code", "date").agg(*[F.max(F.when(F.col("bench") == n, F.col(c))).alias(f"{c}_{n}") for n in names for c in cs])
    rs = wide(on_axis(rs.where("stock_close is not null")), columns)
    averages = union_axis(own_average(bars, "code"), own_average(bench, "bench"))
    sma = relative_strength(with_asof(averages), (31,)).withColumnRenamed("rs31", "rs_sma75")
    sma = wide(on_axis(sma), ["rs_sma75"])
    every = bars.select("code").distinct().withColumn("date", F.explode(days.agg(F.collect_set("date").alias("d")).scalar()))
    have = every.join(z.withColumn("_bar", F.lit(True)), ["code", "date"], "left").join(rs, ["code", "date"], "left").join(sma, ["code", "date"], "left")
    held = [c for c in have.columns if c not in ("code", "date", "_bar")]
    return have.select("code", "date", *[F.when(F.col("_bar"), F.col(c)).alias(c) for c in held])


def lookback_eligible(axis: DataFrame, as_of: str, least: int = 105) -> DataFrame:
    """``code, bench, eligible``: whether both sides have ``least`` closes up to the as-of day."""
    seen = F.col("date") <= F.lit(as_of).cast("date")
    n = lambda c: F.count(F.when(seen, F.col(c)))
    return axis.groupBy(*PAIR).agg(((n("stock_close") >= least) & (n("bench_close") >= least)).alias("eligible"))


def perfect_order_days(bars: DataFrame, run_date: str, spans: tuple[int, int, int] = (25, 75, 200), least_bars: int = 220) -> DataFrame:
    """Trailing rows on which the short average exceeds the middle one and that the long one; null with few or stale bars."""
    w = Window.partitionBy("code").orderBy("date")
    rows = bars.where(F.col("date") <= F.lit(run_date).cast("date"))
    avg = {f"a{n}": F.when(F.count("close").over(w.rowsBetween(-(n - 1), 0)) == n, F.round(F.avg("close").over(w.rowsBetween(-(n - 1), 0)), 9)) for n in spans}
    a, b, c = (F.col(f"a{n}") for n in spans)
    rows = rows.withColumns(avg).withColumns({"ok": F.coalesce((a > b) & (b > c), F.lit(False)), "k": F.row_number().over(w)})
    agg = rows.groupBy("code").agg(F.max("k").alias("n"), F.max("date").alias("last"), F.coalesce(F.max(F.when(~F.col("ok"), F.col("k"))), F.lit(0)).alias("broken"))
    return agg.select("code", F.when((F.col("n") >= least_bars) & (F.col("last") == F.lit(run_date).cast("date")), F.col("n") - F.col("broken")).alias("perfect_order_days"))


def null_ratio(df: DataFrame, columns: list[str]) -> DataFrame:
    """Guard: share of null slots over the given columns."""
    missing = sum((F.sum(F.col(c).isNull().cast("long")) for c in columns[1:]), F.sum(F.col(columns[0]).isNull().cast("long")))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), missing.alias("n_null")).withColumn("null_ratio", F.col("n_null") / F.nullif(F.col("n_rows") * len(columns), F.lit(0)))


def missing_guard(df: DataFrame, columns: list[str], windows: int, benches: int, most: float = 0.5) -> DataFrame:
    """``null_ratio`` over the slots a run should fill, rows x (3 + (windows + 4) x benches), and whether it is too high."""
    slots = 3 + (windows + 4) * benches
    n_null = sum((F.sum(F.col(c).isNull().cast("long")) for c in columns), F.lit(0).cast("long"))
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(n_null, F.lit(0)).alias("n_null"))
    return out.withColumn("ratio", F.col("n_null") / F.nullif(F.col("n_rows") * slots, F.lit(0))).withColumn("too_many", F.coalesce(F.col("ratio") > most, F.lit(False)))


def missing_shares(df: DataFrame, columns: list[str], most: float = 0.5) -> DataFrame:
    """``metric, n_rows, n_missing, share, too_many``: metrics missing (null or NaN) in more than ``most`` of the rows; one aggregate for all."""
    void = lambda c: F.col(c).isNull() | F.isnan(F.col(c))
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(void(c)).alias(f"_{c}") for c in columns])
    rows = agg.select("n_rows", F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"_{c}").alias("n_missing")) for c in columns])).alias("r")).select("r.metric", "n_rows", "r.n_missing")
    share = F.col("n_missing") / F.nullif("n_rows", F.lit(0))
    return rows.withColumns({"share": F.round(share, 6), "too_many": F.coalesce(share > most, F.lit(False))})


def reconcile(stored: DataFrame, rebuilt: DataFrame, keys: list[str], value: str, tolerance: float) -> DataFrame:
    """Keys whose rebuilt value is off the stored one by more than ``tolerance`` (``differs``), or that one side lacks (``missing``, ``extra``)."""
    a, b = stored.select(*keys, F.col(value).alias("_a"), F.lit(1).alias("_l")), rebuilt.select(*keys, F.col(value).alias("_b"), F.lit(1).alias("_r"))
    off = F.coalesce(F.abs(F.col("_a") - F.col("_b")) > tolerance, F.col("_a").isNull() != F.col("_b").isNull())
    state = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").when(off, "differs")
    return a.join(b, keys, "full_outer").select(*keys, state.alias("state"), F.col("_a").alias("stored"), F.col("_b").alias("rebuilt")).where("state is not null")
