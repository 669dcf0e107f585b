"""Streaming forms: windowed counts with lateness, first-seen de-duplication, latest-per-key upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.shared import work_dir  # noqa: F401


def stream_of(spark: SparkSession, path: str, schema: StructType, files: int = 1) -> DataFrame:
    """File-source stream of Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def drain(stream: DataFrame, sink, path: str) -> None:
    """Runs a stream over all that has arrived, through a ``foreachBatch`` function, with its progress kept under ``path``."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()


def append_sink(path: str):
    """``foreachBatch`` function writing each batch to a folder of its own; a replayed batch overwrites its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/b={batch_id}")

    return write


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts per key and tumbling window; state older than the lateness goes."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")


def first_seen(events: DataFrame, time: str, keys: list[str], late: str = "2 days") -> DataFrame:
    """First event of each identity within the lateness."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def first_events(events: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The least event by ``order`` of each identity so far (update mode: a row for each change)."""
    cols = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def drained_latest(stream: DataFrame, keys: list[str], path: str, complete: bool = False) -> DataFrame:
    """Runs an aggregated stream over all that has arrived; of each key the row of its last change, or (``complete``) the last whole result.

    Batches are folders that a replay overwrites; nothing is read back until
    the end, where one pre-aggregated maximum picks the last change.
    """
    query = stream.writeStream.foreachBatch(append_sink(f"{path}/out")).outputMode("complete" if complete else "update").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = stream.sparkSession.read.parquet(f"{path}/out")
    if complete:
        return rows.where(F.col("b") == rows.agg(F.max("b").alias("m")).first()["m"]).drop("b")
    cols = [c for c in rows.columns if c not in (*keys, "b")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), "b").alias("_r")).select(*keys, "_r.*")


def upsert_sink(path: str, keys: list[str], order: list[str]):
    """``foreachBatch`` function keeping the latest row per key in versioned folders; replaying a batch id changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if batch_id:
            rows = rows.unionByName(spark.read.parquet(f"{path}/v={batch_id - 1}"))
        cols = [c for c in rows.columns if c not in keys]
        rows.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_r")).select(*keys, "_r.*").write.mode("overwrite").parquet(f"{path}/v={batch_id}")

    return write
