"""Universe classification, segments, set differences and as-of picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import universe_code

# market/product texts and their classes, first match wins ("~": contained, "=": equal).
MARKET_CLASSES = [
    ("~", "内国株式", "equity_domestic"),
    ("~", "外国株式", "equity_foreign"),
    ("=", "ETF・ETN", "etf_etn"),
    ("=", "REIT・ベンチャーファンド・カントリーファンド・インフラファンド", "reit_funds"),
    ("~", "PRO Market", "pro_market"),
    ("=", "出資証券", "investment_securities"),
]


def classify_market(raw: Column, rules: list[tuple[str, str, str]] = MARKET_CLASSES, default: str = "unknown") -> Column:
    text = F.trim(F.coalesce(raw, F.lit("")))
    out = None
    for how, word, name in rules:
        hit = text.contains(word) if how == "~" else text == word
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def drop_share_classes(df: DataFrame, code: str = "code") -> DataFrame:
    """Codes with five or more digits are classes of shares, not instruments."""
    return df.where(F.length(F.regexp_replace(code, "[^0-9]", "")) < 5)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def trailing_median(rows: DataFrame, key: str, order: list[str], value: str, n: int = 60) -> DataFrame:
    """Exact median of the last ``n`` values per key; null with fewer rows."""
    w = Window.partitionBy(key).orderBy(*[F.desc(o) for o in order])
    last = rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n)
    return last.groupBy(key).agg(F.when(F.count(F.lit(1)) >= n, F.median(value)).alias("median_value"))


def segment(status: Column, n_bars: Column, median: Column, least_bars: int, least_median: float) -> Column:
    """ipo, illiquid or core, in that order of precedence."""
    stale_ok = (status == "stale") & (n_bars >= least_bars)
    return (
        F.when(status.isin("failed", "missing"), "ipo")
        .when(~stale_ok & ((status != "ok") | (n_bars < least_bars)), "ipo")
        .when(median.isNull() | (median < least_median), "illiquid")
        .otherwise("core")
    )


def pick_as_of(releases: DataFrame, run_date: str) -> DataFrame:
    """Newest (snapshot_date, run_id) not after the run date; without one, the first in list order (``fallback_latest``)."""
    ok = F.col("snapshot_date") <= F.lit(run_date).cast("date")
    row = F.struct(*releases.columns)
    got = releases.agg(F.max_by(row, F.when(ok, F.struct("snapshot_date", "run_id"))).alias("a"), F.min_by(row, "ordinal").alias("f"), F.max(ok).alias("hit"))
    return got.where("hit is not null").select(F.when(F.col("hit"), F.col("a")).otherwise(F.col("f")).alias("r"), F.when(F.col("hit"), "as_of").otherwise("fallback_latest").alias("picked")).select("r.*", "picked")


def winners(rows: DataFrame, month: str, order: list[str]) -> DataFrame:
    """Labels each month's winner (greatest order) and its losers, who learn the winner: one pre-aggregated maximum, joined back."""
    key = order[-1]
    best = rows.groupBy(F.col(month).alias("_month")).agg(F.max(F.struct(*order)).alias("_best"))
    out = rows.join(best, F.col(month).eqNullSafe(F.col("_month")))
    return out.select(*[F.col(c) for c in rows.columns], (F.struct(*order) == F.col("_best")).alias("is_winner"), F.col(f"_best.{key}").alias("winner"))


def previous_release(rows: DataFrame, month: str, order: list[str]) -> DataFrame:
    """Each month (``yyyy-MM``) with the winner (greatest order) of the calendar month right before it; null where that month has none."""
    best = rows.groupBy(F.col(month).alias("_m")).agg(F.max_by(order[-1], F.struct(*order)).alias("previous"))
    after = F.date_format(F.add_months(F.to_date(F.concat("_m", F.lit("-01"))), 1), "yyyy-MM")
    return rows.select(month).distinct().join(best.select(after.alias(month), "previous"), month, "left")


def with_names(rows: DataFrame, names: DataFrame, code: str = "code") -> DataFrame:
    """Rows with the ``name`` of their normalised code (the last of a list, by ``ordinal``); blank where there is none."""
    known = names.groupBy(universe_code(F.col(code)).alias("_code")).agg(F.max_by("name", "ordinal").alias("name"))
    return rows.withColumn("_code", universe_code(F.col(code))).join(known, "_code", "left").select(*rows.columns, F.coalesce(F.trim("name"), F.lit("")).alias("name"))


def set_delta(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """``key, change``: added and removed keys, one full outer join of distinct keys."""
    a = current.select(key).where(F.col(key).isNotNull()).distinct().withColumn("a", F.lit(True))
    b = previous.select(key).where(F.col(key).isNotNull()).distinct().withColumn("b", F.lit(True))
    both = a.join(b, key, "full_outer").where("a is null or b is null")
    return both.select(key, F.when(F.col("b").isNull(), "added").otherwise("removed").alias("change"))
