"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from closewright.llm import bpe, collocations, cotrain, dartminhash, decontaminate, langid, license, pii, simhash_trie, suffix_dedup, termscan, topk, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Place of the word vocabulary file, which every executor has."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary()))


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages")).drop("payload", "url")


@query
def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs, langid.train(docs), keep=("doc_id",))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


@query
def op8_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.license_scan(table(spark, sf_dir, "documents"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_spans(docs, pii.train(docs))


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termscan.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.ranked_phrases(table(spark, sf_dir, "documents"))
