"""The queries of this package for __spark_entry__.py: name to (spark, sf_dir) function, and name to DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, embedding_links, lm_scoring, mixing, quality, simhash, suffix_dedup, token_shards, toxicity, warc

END_ID = 2


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer_path(), END_ID)


def op2_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.link_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    held_out = "pmod(crc32(cast(doc_id as string)), 5) = 0"
    return quality.score_quality(docs, labels, learn=f"not ({held_out})").withColumn("held_out", F.expr(held_out))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "benchmark"))
    return decontaminate.scan(docs, benchmark)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), min_bytes=0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in ("documents", "labels"))
    return toxicity.score_toxicity(docs, labels).drop("passages")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("spans")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_shards": op1_token_shards,
    "op2_embedding_links": op2_embedding_links,
    "op3_mix_sources": op3_mix_sources,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "pipeline": pipeline,
}

ORACLES = {"op3_mix_sources": mixing.mix_sql()}
