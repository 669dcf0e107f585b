"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import sql
from tidemark.llm.common import table


def vocab(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import classify

    return classify(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"), vocab("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.fingerprint import fingerprint

    return fingerprint(table(spark, sf_dir, "documents"))


def op5_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.ngramjoin import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"), width=4, num=85, den=100)


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocab("word_bpe_49k.json"), capacity=2048, end_id=0)


def op7_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.tokenfile import write_and_read

    return write_and_read(table(spark, sf_dir, "documents"), vocab("byte_bpe_50k.json"), end_id=2)


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.sharding import shard_rows

    return shard_rows(table(spark, sf_dir, "documents"), shards=24)


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.urlfilter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.codes import compress

    return compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.convtrie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"), base=100, heads=6)


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.substrings import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents"), width=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit() and callable(f)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def llm_oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; the others hold trained models, tokenizers, sketches or seeded orders and are tested against brute force."""
    return {"op5_ngram": sql.NGRAM_JOIN, "op10_topk": sql.TOP_K, "op11_codes": sql.vector_codes(), "op12_trie": sql.PREFIX_TRIE, "op13_repeats": sql.REPEATS}
