"""Global positions without a single-task sort.

``ranked`` range-partitions by the sort keys, sorts each partition and keeps
the partition number and the place in it; ``with_positions`` adds each
partition's start.  The only thing gathered is one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

PLACE_MASK = (1 << 33) - 1


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[Column], name: str) -> DataFrame:
    """Written table with ``_pid`` (range partition, in key order) and ``_idx`` (place in it, from 0)."""
    out = (
        df.repartitionByRange(partitions(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_pid": F.spark_partition_id(), "_idx": F.monotonically_increasing_id().bitwiseAND(F.lit(PLACE_MASK))})
    )
    return materialize(out, name)


def partition_starts(table: DataFrame, weight: Column | None = None) -> dict[int, int]:
    """Sum of ``weight`` (rows if none) in all earlier partitions, by partition: as many entries as partitions."""
    rows = table.groupBy("_pid").agg(F.sum(F.lit(1) if weight is None else weight).alias("n")).collect()
    starts, total = {}, 0
    for r in sorted(rows, key=lambda r: r["_pid"]):
        starts[r["_pid"]] = total
        total += int(r["n"])
    starts[-1] = total
    return starts


def start_column(starts: dict[int, int]) -> Column:
    """Start of the row's partition as an array lookup: one entry per partition."""
    top = max([p for p in starts if p >= 0], default=0)
    values = [0] * (top + 1)
    for p, v in starts.items():
        if p >= 0:
            values[p] = v
    text = ",".join(map(str, values))
    return F.element_at(F.from_json(F.lit(f"[{text}]"), "array<bigint>"), F.col("_pid") + 1)


def with_positions(table: DataFrame, column: str = "_pos") -> tuple[DataFrame, int]:
    """Adds the global place of each row of a ``ranked`` table; also returns the row count."""
    starts = partition_starts(table)
    return table.withColumn(column, start_column(starts) + F.col("_idx")), starts[-1]
