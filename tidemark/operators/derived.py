"""Snapshots, series, digests and upserts of derived data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_flags(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Metric values with NaN and infinity voided, and ``_flags`` naming what was missing or not finite."""
    off = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    named = lambda test: F.array_compact(F.array(*[F.when(test(F.col(m)), F.lit(m)) for m in metrics]))
    flags = F.struct(named(lambda c: c.isNull()).alias("missing_metrics"), named(lambda c: F.coalesce(off(c), F.lit(False))).alias("non_finite_metrics"))
    return df.withColumns({"_flags": flags}).withColumns({m: F.when(~off(F.col(m)), F.col(m)) for m in metrics})


def digest_of_keys(df: DataFrame, group: str, key: str) -> DataFrame:
    """SHA-256 of a group's sorted keys joined by newlines."""
    return df.groupBy(group).agg(F.sha2(F.array_join(F.sort_array(F.collect_set(key)), "\n"), 256).alias("digest"), F.count_distinct(key).alias("n_keys"))


def decimal_text(c: Column) -> Column:
    """Canonical decimal text of the exact binary value: ten places, half-even, no trailing zeros, no negative zero."""
    from tidemark.operators.rules import exact_decimal

    return exact_decimal(c)


def field(name: str):
    return lambda x: x[name]


def series_arrays(df: DataFrame, keys: list[str], date: str, metrics: list[str]) -> DataFrame:
    """Parallel arrays per key in date order."""
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(date, *metrics))).alias("_s"))
    return packed.select(*keys, F.transform("_s", lambda x: x[date]).alias("dates"), *[F.transform("_s", field(m)).alias(m) for m in metrics])


def merge_series(current: DataFrame, new: DataFrame, keys: list[str], overwrite: bool = True) -> DataFrame:
    """Overwrites equal keys with new rows, or (``overwrite=False``) only adds keys that are absent."""
    if overwrite:
        return current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)
    return current.unionByName(new.join(current.select(*keys).distinct(), keys, "left_anti"))


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Latest row per key; a new row wins unless the old one's date is later."""
    rows = old.withColumn("_in", F.lit(0)).unionByName(new.withColumn("_in", F.lit(1)))
    cols = [c for c in rows.columns if c not in [*keys, "_in"]]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(date, "_in")).alias("_r")).select(*keys, "_r.*")


def supersede(objects: DataFrame, generation: int) -> DataFrame:
    """Status after a commit: older committed objects of a key that the generation rewrites are superseded."""
    fresh = objects.where(F.col("generation") == generation).select("object_key").distinct().withColumn("_hit", F.lit(True))
    status = F.when(F.col("generation") == generation, "committed").when(F.col("_hit") & (F.col("status") == "committed"), "superseded").otherwise(F.col("status"))
    return objects.join(fresh, "object_key", "left").withColumn("status", status).drop("_hit")


def zip_arrays(df: DataFrame, columns: list[str]) -> DataFrame:
    """Positional zip of parallel arrays, one row per place."""
    return df.select("*", F.posexplode(F.arrays_zip(*columns)).alias("n", "_z")).select(*[c for c in df.columns if c not in columns], "n", *[F.col("_z")[c].alias(c) for c in columns])


def classify_int(c: Column, kind: str) -> tuple[Column, Column, Column]:
    """Value, whether it counts as missing, and whether as not finite, of a column coerced to an integer metric.

    Text that is no integer and numbers with a fraction are missing; infinite
    and NaN numbers are not finite.
    """
    if kind == "string":
        value = F.when(F.trim(c).rlike("^[+-]?[0-9]+$"), F.trim(c).try_cast("long"))
        return value, value.isNull(), F.lit(False)
    if kind in ("double", "float"):
        off = F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
        value = F.when(~off & (c == F.floor(c)), c.cast("long"))
        return value, value.isNull() & ~off, off
    return c.cast("long"), c.isNull(), F.lit(False)


def number_or_null(c: Column) -> Column:
    """Number of a text to six places; blanks, words and NaN are null."""
    x = F.trim(c).try_cast("double")
    return F.when(~F.isnan(x), F.round(x, 6))


def project_rows(df: DataFrame, bench: str, metrics: list[str], scalars: list[str], as_of: str, identity: list[str] | None = None, news: list[tuple[str, str]] | None = None) -> DataFrame:
    """Grid rows of text columns for one benchmark: ``m_bench`` becomes ``m``; the name is always copied.

    The row's day is ``date`` or, where that is blank or missing, ``trade_date``.  Only
    rows of the as-of day keep identity columns (blank ones void, others as
    they are) and their news: title and url of each ``news`` slot that has a
    title, or null without any.
    """
    have = set(df.columns)
    there = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    trimmed = lambda c: F.trim(F.coalesce(there(c), F.lit("")))
    same = F.trim(F.coalesce(F.nullif(there("date"), F.lit("")), there("trade_date"), F.lit(""))) == as_of
    code = trimmed("code")
    kept = [F.when(same & (trimmed(c) != ""), F.col(c)).alias(c) for c in identity or [] if c in have]
    items = [F.when(trimmed(t) != "", F.struct(trimmed(t).alias("title"), F.nullif(trimmed(u), F.lit("")).alias("url"))) for t, u in news or []]
    bundle = F.array_compact(F.array(*items)) if items else F.array().cast("array<struct<title:string,url:string>>")
    return df.select(
        F.lpad(code, F.greatest(F.length(code), F.lit(4)), F.lit("0")).alias("code"), F.coalesce(there("name"), F.lit("")).alias("name"),
        *[number_or_null(there(f"{m}_{bench}")).alias(m) for m in metrics], *[number_or_null(there(m)).alias(m) for m in scalars],
        F.when(same & (F.size(bundle) > 0), bundle).alias("event_news_bundle"), *kept,
    )


def seed_outcome(candidates: DataFrame, existing: DataFrame, key: str, date: str, day: str) -> DataFrame:
    """``key, outcome``: write, or noop where the day is already there."""
    have = existing.where(F.col(date) == F.lit(day).cast("date")).select(key).distinct().withColumn("_have", F.lit(True))
    rows = candidates.select(key).where(F.length(F.trim(F.col(key).cast("string"))) > 0)
    return rows.join(have, key, "left").select(key, F.when(F.col("_have"), "resolved_noop").otherwise("write").alias("outcome"))


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: an empty result means equal sets."""
    a, b = left.select(key).distinct().withColumn("a", F.lit(True)), right.select(key).distinct().withColumn("b", F.lit(True))
    return a.join(b, key, "full_outer").where("a is null or b is null").select(key, F.when(F.col("a").isNull(), "right").otherwise("left").alias("only_in"))


def staged_rows(batches: DataFrame, payload: str, schema: str, keys: list[str], ordinal: str) -> DataFrame:
    """Rows of JSON arrays, the last of a key winning (by batch, then place); a row without a key is an error."""
    rows = batches.select(ordinal, F.posexplode(F.from_json(payload, f"array<struct<{schema}>>")).alias("_n", "_r")).select("_n", ordinal, "_r.*")
    rows = rows.withColumns({k: F.when(F.col(k).isNull(), F.raise_error(F.lit(f"staged row without {k}")).cast(rows.schema[k].dataType)).otherwise(F.col(k)) for k in keys})
    cols = [c for c in rows.columns if c not in {*keys, "_n", ordinal}]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(ordinal, "_n")).alias("_x")).select(*keys, "_x.*")
