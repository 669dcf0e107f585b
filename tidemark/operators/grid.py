"""Result grids: column filters, null-last sorts, ranked preview, list filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import half_width


def column_filter(column: str, op: str, a=None, b=None) -> Column:
    """One grid filter; null never passes a comparison; ``between`` takes bounds in any order and a missing bound passes."""
    c = F.col(column)
    if op == "contains":
        if not str(a or "").strip():
            return F.lit(True)
        if column == "code":  # codes compare in half-width upper case
            wide = lambda x: F.upper(F.trim(half_width(x.cast("string"))))
            return F.coalesce(F.contains(wide(c), wide(F.lit(a))), F.lit(False))
        return F.coalesce(F.contains(F.lower(c.cast("string")), F.lower(F.lit(a))), F.lit(False))
    if op in ("isnull", "notnull"):
        return c.isNull() if op == "isnull" else c.isNotNull()
    if op == "between":
        if a is None or b is None:
            return F.lit(True)
        return F.coalesce(c.between(min(a, b), max(a, b)), F.lit(False))
    compare = {"eq": c == a, "gt": c > a, "gte": c >= a, "lt": c < a, "lte": c <= a}[op]
    return F.coalesce(compare, F.lit(False))


def apply_filters(df: DataFrame, filters: list[tuple]) -> DataFrame:
    """All filters together; a single predicate that reaches the scan where it can."""
    return df.where(reduce(lambda x, y: x & y, [column_filter(*f) for f in filters], F.lit(True)))


def sort_null_last(df: DataFrame, column: str, descending: bool, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(column) if descending else F.asc_nulls_last(column), F.asc(tie))


def preview(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Rows at or above the n-th largest value, ties kept, nulls dropped.

    The threshold comes from a distributed top-n, so no window sees all rows.
    """
    top = df.where(F.col(column).isNotNull()).orderBy(F.desc(column)).select(F.col(column).alias("_v")).limit(n)
    return df.join(F.broadcast(top.agg(F.min("_v").alias("_least"))), F.col(column) >= F.col("_least")).drop("_least")


def all_negative(columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns])


def top_per_key(df: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """First n rows of each key; the rank limit is applied before and after the exchange."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).drop("_k")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    cols = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def switch_benchmark(df: DataFrame, old: str, new: str) -> DataFrame:
    """Shows the other benchmark's columns: ``x_old`` goes, ``x_new`` stays."""
    return df.select(*[c for c in df.columns if not c.endswith(f"_{old}") or f"{c[: -len(old)]}{new}" not in df.columns])


def favourite_filter(df: DataFrame, lists: DataFrame, code: str, chosen: list[str], blank: bool) -> DataFrame:
    """Rows of the chosen lists, and with ``blank`` those in no list.

    ``__none__`` among the chosen keeps nothing; without any list chosen,
    members stay unless only blanks are asked for.
    """
    if "__none__" in chosen:
        return df.where(F.lit(False))
    hit = F.bool_or(F.col("list_id").isin(*chosen)) if chosen else F.lit(not blank)
    member = lists.groupBy(F.col("code").alias(code)).agg(F.lit(True).alias("_in"), hit.alias("_hit"))
    keep = F.when(F.col("_in").isNull(), F.lit(blank)).otherwise(F.col("_hit"))
    return df.join(member, code, "left").where(keep).drop("_in", "_hit")
