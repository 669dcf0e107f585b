"""Object sink: one deterministic compressed object per key, under a commit that takes all or nothing.

A Python data source writer.  Tasks write their objects under names of their
own attempt; the commit checks sizes and contents of all that the tasks
report, moves them to their final names and writes a manifest with size and
SHA-256 of each object.  A task that is lost, an object over the limit, or a
key that two tasks wrote leaves nothing behind under a final name.  Rows must
come grouped by key (``write_objects`` sees to that), so a task holds one
object's row at a time.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Compression level, and most bytes of an object.
LEVEL, MOST_BYTES = 9, 8 << 20
#: Beside the objects; no key has this name.
MANIFEST = "manifest.jsonl"


def local_path(folder: str) -> str:
    """A mounted shared folder as the tasks see it; other stores have no plain files."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"objects need a folder that all tasks mount, not {folder}")
    return url.path.rstrip("/")


def packed(text: str) -> bytes:
    """Gzip without name or time: equal texts give equal bytes."""
    out = io.BytesIO()
    with gzip.GzipFile(filename="", mode="wb", fileobj=out, compresslevel=LEVEL, mtime=0) as f:
        f.write(text.encode())
    return out.getvalue()


@dataclass
class Wrote(WriterCommitMessage):
    objects: list


class ObjectWriter(DataSourceWriter):
    def __init__(self, folder: str, most: int, create_only: bool):
        self.folder, self.most, self.create_only = folder, most, create_only
        self.staging = os.path.join(folder, f".staging-{uuid.uuid4().hex}")

    def write(self, rows: Iterator) -> Wrote:
        from pyspark import TaskContext

        mine = os.path.join(self.staging, f"{TaskContext.get().taskAttemptId()}")
        os.makedirs(mine, exist_ok=True)
        done = []
        for row in rows:
            key, data = row["key"], packed(row["body"])
            if len(data) > self.most:
                raise ValueError(f"object {key} has {len(data)} bytes; at most {self.most}")
            name = hashlib.sha256(key.encode()).hexdigest()
            with open(os.path.join(mine, name), "wb") as f:
                f.write(data)
            done.append({"key": key, "size_bytes": len(data), "sha256": hashlib.sha256(data).hexdigest(), "at": os.path.join(mine, name)})
        return Wrote(done)

    def commit(self, messages: list) -> None:
        """All or nothing: every object is checked before the first one moves."""
        found = [o for m in messages if m is not None for o in m.objects]
        seen: set = set()
        try:
            for o in found:
                target = os.path.join(self.folder, o["key"])
                if o["key"] in seen:
                    raise ValueError(f"object {o['key']} was written twice")
                seen.add(o["key"])
                if os.path.exists(target) and self.create_only and file_digest(target) != o["sha256"]:
                    raise ValueError(f"object {o['key']} exists with other contents")
                if os.path.getsize(o["at"]) != o["size_bytes"]:
                    raise ValueError(f"object {o['key']} is cut short")
            for o in found:
                target = os.path.join(self.folder, o["key"])
                os.makedirs(os.path.dirname(target), exist_ok=True)
                os.replace(o["at"], target)
            lines = "".join(json.dumps({k: o[k] for k in ("key", "size_bytes", "sha256")}, ensure_ascii=False) + "\n" for o in sorted(found, key=lambda o: o["key"]))
            with open(os.path.join(self.staging, "manifest"), "w", encoding="utf-8") as f:
                f.write(lines)
            os.replace(os.path.join(self.staging, "manifest"), os.path.join(self.folder, MANIFEST))
        finally:
            shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


class ObjectSink(DataSource):
    """``format("tidemark_objects")``: rows of ``key, body`` to gzip objects in ``path``; options ``most_bytes``, ``create_only``."""

    @classmethod
    def name(cls) -> str:
        return "tidemark_objects"

    def schema(self) -> str:
        return "key string, body string"

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        folder = local_path(self.options["path"])
        os.makedirs(folder, exist_ok=True)
        return ObjectWriter(folder, int(self.options.get("most_bytes", MOST_BYTES)), self.options.get("create_only", "false") == "true")


def write_objects(objects: DataFrame, folder: str, most_bytes: int = MOST_BYTES, create_only: bool = False) -> None:
    """``key, body`` rows as objects under ``folder`` (shared by all tasks), with a manifest; all are there afterwards or none is new."""
    objects.sparkSession.dataSource.register(ObjectSink)
    objects.select("key", "body").write.format("tidemark_objects").mode("append").option("path", folder).option("most_bytes", str(most_bytes)).option("create_only", str(create_only).lower()).save()


def series_objects(series: DataFrame, key: str, date: str, metrics: list[str], prefix: str, part: str) -> DataFrame:
    """``key, body`` of one JSON object per key and ``part`` (say, a year): parallel arrays in date order.

    An object is bounded by what a part of one key holds.
    """
    rows = F.array_sort(F.collect_list(F.struct(date, *metrics)))
    packed_ = series.groupBy(key, part).agg(rows.alias("_s"))
    column = lambda c: F.transform("_s", lambda x: x[c])
    body = F.to_json(F.struct(F.col(key).alias("instrument_code"), F.col(part).alias(part), F.transform(column(date), lambda d: d.cast("string")).alias("dates"), F.struct(*[column(m).alias(m) for m in metrics]).alias("metrics")), {"ignoreNullFields": "false"})
    return packed_.select(F.concat(F.lit(f"{prefix}/{part}="), F.col(part).cast("string"), F.lit("/code="), F.regexp_replace(F.col(key).cast("string"), "[^0-9A-Za-z_.-]", "_"), F.lit(".json.gz")).alias("key"), body.alias("body"))


def scan_objects(spark: SparkSession, folder: str) -> DataFrame:
    """``key, size_bytes, sha256`` of every object under ``folder``; the manifest, hidden and empty files do not count (no object is empty)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(folder)
    key = F.regexp_replace(F.substring_index("path", urlparse(folder).path.rstrip("/"), -1), "^/+", "")
    return files.select(key.alias("key"), F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256")).where(F.col("key") != MANIFEST)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("key string, size_bytes long, sha256 string").json(f"{folder.rstrip('/')}/{MANIFEST}")


def manifest_faults(objects: DataFrame, manifest: DataFrame) -> DataFrame:
    """``key, fault``: missing (named, not there), extra (there, not named), repeated (named twice) or changed (size or contents); empty: all is as the manifest says."""
    named = manifest.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("size_bytes").alias("_size"), F.min("sha256").alias("_sha"))
    both = objects.join(named, "key", "full_outer")
    fault = F.when(F.col("sha256").isNull(), "missing").when(F.col("n").isNull(), "extra").when(F.col("n") > 1, "repeated").when((F.col("size_bytes") != F.col("_size")) | (F.lower("sha256") != F.lower("_sha")), "changed")
    return both.select("key", fault.alias("fault")).where("fault is not null")


def publish_verified(spark: SparkSession, folder: str, pointer: str) -> bool:
    """Moves the ``pointer`` file to ``folder`` only if nothing under it is at fault; the move replaces the file at once."""
    if not manifest_faults(scan_objects(spark, folder), read_manifest(spark, folder)).isEmpty():
        return False
    target = local_path(pointer)
    with open(f"{target}.new", "w", encoding="utf-8") as f:
        f.write(folder)
    os.replace(f"{target}.new", target)
    return True
