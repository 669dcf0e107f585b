"""Resumable batches: a ledger of finished key chunks, committed after their data.

A run is named by a fingerprint of its parameters and keys.  Keys fall into
chunks; chunks are worked off in waves, a wave being one Spark job over many
chunks.  A wave first writes its data under a name of its own and then adds
its chunks to the ledger, so data without a ledger row (a wave that broke, or
two drivers that worked on one chunk) never counts.  A restart reads the
ledger and does the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "fingerprint string, wave string, chunk long, n_keys long, n_rows long, at timestamp"


def run_fingerprint(rows: DataFrame, key: str, *parameters: str) -> str:
    """Name of a run: its parameters and its set of keys, whatever their order."""
    x = F.xxhash64(F.col(key))
    keys = rows.select(key).distinct().agg(F.count(F.lit(1)).alias("n"), F.bit_xor(x).alias("x"), F.sum(F.pmod(x, F.lit(1 << 31))).alias("s"))
    return keys.select(F.sha2(F.concat_ws("\n", *[F.lit(p) for p in parameters], "n", "x", "s"), 256)).first()[0]


def by_hash(key: str, chunks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(chunks))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All ledger rows under ``path``; the first row of a chunk counts if two waves finished it."""
    try:
        rows = spark.read.schema(LEDGER).parquet(f"{path}/ledger")
        rows.isEmpty()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)
    return rows.groupBy("fingerprint", "chunk").agg(F.min_by(F.struct("wave", "n_keys", "n_rows", "at"), F.struct("at", "wave")).alias("r")).select("fingerprint", "r.wave", "chunk", "r.n_keys", "r.n_rows", "r.at")


def run_chunks(rows: DataFrame, key: str, chunk: Column, work: Callable[[DataFrame], DataFrame], path: str, fingerprint: str, wave_chunks: int = 200, waves: int | None = None) -> int:
    """Work off the chunks that the ledger lacks, at most ``waves`` waves; returns how many chunks are still open.

    ``work`` maps the rows of a wave and keeps the key and the ``_chunk`` column.
    """
    spark = rows.sparkSession
    cut = rows.where(F.col(key).isNotNull()).withColumn("_chunk", chunk)
    while True:
        done = ledger(spark, path).where(F.col("fingerprint") == fingerprint).select(F.col("chunk").alias("_chunk"))
        pending = cut.select("_chunk").distinct().join(done, "_chunk", "left_anti")
        todo = [r[0] for r in pending.orderBy("_chunk").limit(wave_chunks).collect()]
        if not todo or waves == 0:
            return pending.count() if todo else 0
        wave = uuid.uuid4().hex
        mine = cut.where(F.col("_chunk").isin(todo))
        work(mine).write.partitionBy("_chunk").parquet(f"{path}/data/{wave}")
        sizes = mine.groupBy("_chunk").agg(F.count_distinct(key).alias("n_keys"), F.count(F.lit(1)).alias("n_rows"))
        entry = sizes.select(F.lit(fingerprint).alias("fingerprint"), F.lit(wave).alias("wave"), F.col("_chunk").alias("chunk"), "n_keys", "n_rows", F.current_timestamp().alias("at"))
        entry.coalesce(1).write.mode("append").parquet(f"{path}/ledger")
        waves = None if waves is None else waves - 1


def finished_rows(spark: SparkSession, path: str, fingerprint: str) -> DataFrame:
    """Results of the run's finished chunks, each from the wave that the ledger names."""
    mine = ledger(spark, path).where(F.col("fingerprint") == fingerprint).select("wave", "chunk")
    waves = [r[0] for r in mine.select("wave").distinct().collect()]  # one row a wave
    if not waves:
        raise ValueError(f"no finished chunk of {fingerprint} under {path}")
    rows = None
    for w in sorted(waves):
        some = spark.read.parquet(f"{path}/data/{w}").withColumn("_wave", F.lit(w))
        rows = some if rows is None else rows.unionByName(some)
    return rows.join(mine, (F.col("_wave") == F.col("wave")) & (F.col("_chunk") == F.col("chunk")), "left_semi").drop("_wave", "_chunk")
