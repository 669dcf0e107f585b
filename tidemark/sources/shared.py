"""The folder that driver and executors share, and tables written there to cut a plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A local session's own folder, made on first use; never used on a cluster.
_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, one temp folder of a local master, and an error on any other."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _LOCAL:
        _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='tidemark-')}")
    return _LOCAL[0]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: later jobs depend on the table alone."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
