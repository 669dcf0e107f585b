"""Sinks: partitioned tables, JSON lines, create-only objects and staged publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: str, dimension: list[str] | None = None) -> None:
    """One folder per value of ``by``; a value with many rows is written by many tasks; ``dimension`` reports values without rows."""
    df.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)
    if dimension is not None:
        have = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))
        want = df.sparkSession.createDataFrame([(d,) for d in dimension], f"{by} string")
        want.join(have, by, "left").na.fill({"rows": 0}).write.mode("overwrite").parquet(f"{path.rstrip('/')}_index")


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """Globally sorted JSON lines; nulls are written."""
    df.orderBy(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    df.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, trade_date: str) -> None:
    """Replace one trade date's partition of a snapshot table."""
    df.withColumn("trade_date", F.lit(trade_date).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trade_date").parquet(path)


def put_create_only(df: DataFrame, path: str) -> None:
    """Fails when the object exists."""
    df.write.mode("errorifexists").parquet(path)


def upsert_by_key(current: DataFrame | None, new: DataFrame, keys: list[str], path: str) -> None:
    """Overwrite-by-key into a fresh version folder: rows of ``new`` replace rows with equal keys."""
    out = new if current is None else current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)
    out.write.mode("errorifexists").parquet(path)


def publish(df: DataFrame, staging: str, least_rows: int, columns: list[str]) -> bool:
    """Write to staging and gate it: expected header and row count. The caller moves its pointer only on True."""
    df.write.mode("overwrite").parquet(staging)
    back = df.sparkSession.read.parquet(staging)
    return back.columns == columns and back.limit(least_rows).count() >= least_rows
