"""Sharding by proportional stratified interleaving (law ``rows``).

Rows of each source are put in a seeded random order; a row's fractional rank
is (rank + 1/2) / rows of its source.  Sorted by fractional rank, every
stretch of the sequence holds the sources in their overall proportion, so
cutting it into equal stretches gives shards that match the mixture, with row
counts at most one apart.

Only ids, sizes, checksums and the source move; texts never do.  A source
that holds most rows spans many range partitions.  Nulls: a null source is a
source of its own, a null text has size 8 and checksum 0, a null id sorts
first.  Repeated rows stay separate rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import only
from tidemark.llm.ordering import ranked, with_positions

#: Largest table of (partition, source) starts that is broadcast: 50,000 rows of 40 bytes.
BROADCAST_ROWS = 50_000


def shard_rows(docs: DataFrame, shards: int = 24, seed: int = 20240229) -> DataFrame:
    rows = only(docs, "doc_id", "text", "source").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), "source")).alias("stratum"),
    )
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    keys = ["stratum", "h", "doc_id", "text_crc32", "size"]
    first = ranked(rows, [F.col(k) for k in keys], "shard-strata")
    parts = first.groupBy("_pid", "stratum").agg(F.count(F.lit(1)).alias("n"), F.min("_idx").alias("lo"))
    by_stratum = Window.partitionBy("stratum")
    starts = parts.select(
        "_pid",
        "stratum",
        (F.sum("n").over(by_stratum.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
        F.sum("n").over(by_stratum).alias("total"),
        "lo",
    )
    if parts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    placed = first.join(starts, ["_pid", "stratum"]).select(
        *keys, ((F.coalesce("before", F.lit(0)) + F.col("_idx") - F.col("lo") + F.lit(0.5)) / F.col("total")).alias("frac")
    )
    second = ranked(placed, [F.col(k) for k in ["frac", *keys]], "shard-sequence")
    seq, n = with_positions(second)
    out = seq.withColumn("shard", F.expr(f"cast((_pos * {shards}) div {max(n, 1)} as int)"))
    start = F.expr(f"(cast(shard as bigint) * {max(n, 1)} + {shards - 1}) div {shards}")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("_pos") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.when(F.col("stratum") == "", None).otherwise(F.substring("stratum", 2, 1 << 30)).alias("source"),
    )
