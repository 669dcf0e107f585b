"""Shared helpers: table access, the shared folder, narrow rewrites of text columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.shared import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it.

    Cuts the lineage and survives lost executors: the written table is the
    only thing later jobs depend on.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_place(df: DataFrame) -> DataFrame:
    """The same columns as ``c0, c1, ...``: names that clash, even in case alone, do no harm."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> int:
    """Place of the column of exactly this name, else of the only one that differs in case."""
    if name in df.columns:
        return df.columns.index(name)
    near = [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if len(near) != 1:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return near[0]


def only(df: DataFrame, *names: str) -> DataFrame:
    """Select top-level columns by name; extra columns with any name are ignored."""
    return by_place(df).select(*[F.col(f"c{place_of(df, n)}").alias(n) for n in names])


def with_results(df: DataFrame, run: Callable[[Iterator], Iterator], text: str, added: dict[str, str]) -> DataFrame:
    """``df`` mapped by ``run``, which sees the given column as ``text`` and all others by place, and appends the ``added`` columns (name: type)."""
    at = place_of(df, text)
    base = by_place(df).withColumnRenamed(f"c{at}", "text")
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in base.schema] + [f"_r{i} {t}" for i, t in enumerate(added.values())]
    return base.mapInPandas(run, ", ".join(fields)).toDF(*df.columns, *added)


#: What the operator that this worker process served last keeps between tasks.
_HELD: dict = {}


def hold(key: tuple, make: Callable[[], object]):
    """``make()``, kept while the worker serves the same operator; what another one kept is dropped first."""
    if key not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the system: a worker process stays idle beside later stages, which need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def row_chunks(batches: Iterator, max_chars: int = 8_000_000) -> Iterator:
    """Cut pandas batches with a ``text`` column so that a piece holds bounded text."""
    for pdf in batches:
        lo, size = 0, 0
        for i, t in enumerate(pdf["text"].array):
            n = len(t) if isinstance(t, str) else 0
            if size + n > max_chars and i > lo:
                yield pdf.iloc[lo:i]
                lo, size = i, 0
            size += n
        if lo < len(pdf):
            yield pdf.iloc[lo:]
        pdf = None
    give_back()
