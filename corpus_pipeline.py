"""Corpus pipeline: quality, toxicity, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes every stage's result in the shared folder and rereads it for the next.

All stages read whole texts of any length, take ``doc_id`` and ``text`` by
name and other columns of any name and type by place, and give an empty table
for an empty one.  A stage that keeps rows gives back all their columns as
they are; null texts count as empty and are judged as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ngramjoin, packing, quality, toxicity
from tidemark.llm.common import by_place, materialize, only, place_of, table
from tidemark.llm.queries import vocab

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows of a batch between Spark and a Python worker: texts are long, and batches wait on both sides.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Bounds what executors hold beside their heap; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer keeps."""
    small_batches(spark)
    return quality.kept(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the window network."""
    small_batches(spark)
    return toxicity.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose five-word shingle sets chain at Jaccard 0.8 or more: that of least id, null ids last.

    Rows are told apart by a 64-bit hash of id and text, so null ids and ids
    with several texts link by their texts as others do.  Of rows equal in id
    and text one stays; rows without a shingle set all stay.
    """
    small_batches(spark)
    base, id_, text = by_place(docs), f"c{place_of(docs, 'doc_id')}", f"c{place_of(docs, 'text')}"
    keyed = base.withColumn("key", F.xxhash64(F.col(id_).isNull(), id_, text))
    groups = ngramjoin.jaccard_components(keyed.select(F.col("key").alias("doc_id"), F.col(text).alias("text")), width=5, num=80, den=100)
    groups = groups.groupBy(F.col("doc_id").alias("key")).agg(F.max("component_id").alias("c"), F.max("n_shingles").alias("k"), F.count(F.lit(1)).alias("n"))
    ids = keyed.groupBy("key").agg(F.min(id_).alias("id"))
    groups = materialize(groups.where("k > 0").join(ids, "key"), "near-groups")
    first = F.struct(F.col("id").isNull(), "id", "key")
    shared = groups.groupBy("c").agg(F.min_by(F.struct("key", "n"), first).alias("r"), F.sum("n").alias("rows")).where("rows > 1")
    # The keys of groups of several rows; a group's least key is its name c.
    grouped = groups.where("c <> key").select("key").unionByName(shared.select(F.col("c").alias("key")))
    stays = shared.select("r.key", (F.col("r.n") > 1).alias("repeats"))
    judged = grouped.join(stays, "key", "left").select("key", F.when(F.col("repeats").isNull(), "goes").when(F.col("repeats"), "once").otherwise("stays").alias("fate"))
    judged = materialize(judged, "near-judged")
    free, met = split_by_keys(keyed, judged, "key")
    met = met.join(judged, "key", "left")
    rest = F.struct(F.lit(0).alias("none"), *[c for c in base.columns if c not in (id_, text)])
    once = met.where("fate = 'once'").groupBy("key", id_, text).agg(F.min_by(rest, F.to_json(rest)).alias("r")).select(id_, text, "r.*")
    straight = met.where("fate is null or fate = 'stays'")
    parts = [p.select(*base.columns) for p in (free, straight, once)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).toDF(*docs.columns)


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose key is surely not among ``keys``, and the others, some of them by chance.

    Decided without a shuffle, by a bitmap of ``1 << 26`` bits in words of 64:
    the broadcast side has at most ``1 << 20`` rows of two longs, however many
    keys there are.
    """
    bit = F.pmod(F.xxhash64(F.lit(9), F.col(key)), F.lit(1 << 26))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    words = keys.select(F.shiftright(bit, 6).alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))
    marked = rows.withColumn("_word", F.shiftright(bit, 6)).join(F.broadcast(words), "_word", "left")
    hit = F.coalesce(F.col("_mask").bitwiseAND(mask) != 0, F.lit(False))
    return marked.where(~hit).drop("_word", "_mask"), marked.where(hit).drop("_word", "_mask")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, vocab("word_bpe_49k.json"), capacity=2048, end_id=0)


STAGES = [("quality", quality_stage), ("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]

#: No SQL expresses trained models and packing; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
