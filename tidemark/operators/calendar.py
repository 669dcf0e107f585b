"""Union calendars, as-of values and anchored returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

PAIR = ["code", "bench"]


def pair_window() -> WindowSpec:
    return Window.partitionBy(*PAIR).orderBy("date")


def union_axis(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """``code, bench, date, stock_close, bench_close, pos``: outer join of each instrument with each benchmark on date.

    Bars are read once and shuffled once, by code; that partitioning serves
    the merging of equal dates and every later window of a (code, bench)
    pair.  An instrument's own series is an array in date order for a moment
    (bounded by its days).  The benchmarks' calendar comes as one scalar
    subquery, so there is no join: its size is the number of sessions.
    """
    own = bars.groupBy("code").agg(F.collect_list(F.struct("date", F.col("close").alias("stock_close"), F.lit(None).cast("double").alias("bench_close"))).alias("own"))
    series = bench.groupBy("bench").agg(F.collect_list(F.struct("date", F.lit(None).cast("double").alias("stock_close"), F.col("close").alias("bench_close"))).alias("days"))
    pairs = own.withColumn("_c", F.explode(series.agg(F.collect_list(F.struct("bench", "days")).alias("c")).scalar()))
    rows = pairs.select("code", F.col("_c")["bench"].alias("bench"), F.explode(F.concat("own", F.col("_c")["days"])).alias("_r"))
    merged = rows.groupBy("code", "bench", F.col("_r")["date"].alias("date")).agg(F.max(F.col("_r")["stock_close"]).alias("stock_close"), F.max(F.col("_r")["bench_close"]).alias("bench_close"))
    return merged.withColumn("pos", F.row_number().over(pair_window()))


def with_asof(axis: DataFrame) -> DataFrame:
    """Adds the last known closes ``s`` and ``b`` on every axis date (backward as-of join)."""
    w = pair_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return axis.withColumns({"s": F.last("stock_close", True).over(w), "b": F.last("bench_close", True).over(w)})


def anchored_return(column: str, t: int, w: WindowSpec) -> Column:
    """As-of value now over the as-of value ``t`` axis positions before, minus one; null without either or at zero."""
    return F.col(column) / F.nullif(F.lag(column, t).over(w), F.lit(0.0)) - 1


def with_run_anchor(axis: DataFrame, run_date: str) -> DataFrame:
    """Adds ``p``: position of the pair's last axis date not after the run date (a window on the pair's own partition)."""
    seen = F.when(F.col("date") <= F.lit(run_date).cast("date"), F.col("pos"))
    return axis.withColumn("p", F.max(seen).over(Window.partitionBy(*PAIR)))


def at_run_date(df: DataFrame, run_date: str, keys: list[str]) -> DataFrame:
    """Each key's last row not after the run date; pre-aggregated, no window."""
    cols = [c for c in df.columns if c not in keys]
    rows = df.where(F.col("date") <= F.lit(run_date).cast("date"))
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "date").alias("_r")).select(*keys, "_r.*")


def align_to_axis(axis_dates: DataFrame, series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Fixed-length array per key: the axis left-joined with the series, missing days null, in date order.

    The axis (one entry per session) is a scalar subquery; a key's values on
    it are looked up in a map of at most as many entries.
    """
    axis = axis_dates.agg(F.array_sort(F.collect_set("date")).alias("a")).scalar()
    rows = series.select(*keys, "date", value).withColumn("_a", axis)
    on_axis = F.when(F.array_contains("_a", F.col("date")), F.struct("date", value))
    packed = rows.groupBy(*keys).agg(F.map_from_entries(F.array_compact(F.collect_list(on_axis))).alias("_m"))
    return packed.withColumn("_a", axis).select(*keys, F.transform("_a", lambda d: F.element_at("_m", d)).alias(value))


def trailing_axis(df: DataFrame, axis_dates: DataFrame) -> DataFrame:
    """Rows of a series form that fall on the axis: every metric of every axis day in one pass."""
    return df.join(F.broadcast(axis_dates.select("date")), "date", "left_semi")


def require_session(bench: DataFrame, as_of: str) -> DataFrame:
    """``bench, has_bar``: whether each benchmark has a bar on the as-of day; a run stops on any False."""
    return bench.groupBy("bench").agg(F.bool_or(F.col("date") == F.lit(as_of).cast("date")).alias("has_bar"))
