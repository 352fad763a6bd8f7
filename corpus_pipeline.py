"""Documents to token shards: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.

Defined cases, for every stage: documents' columns may hold nulls, and extra columns of
any name pass all stages but the last unharmed; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.decontaminate import drop_contaminated
from tidewater.llm.mixing import mix
from tidewater.llm.near_copies import keep_one
from tidewater.llm.quality import keep_good
from tidewater.llm.queries import END_ID, tokenizer_path
from tidewater.llm.token_shards import encode_documents
from tidewater.workspace import Workspace


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject; without labels of both classes all stay."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five-word shingles, similarity 0.8); null, empty and blank texts are copies of each other."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word passage of a benchmark item; null and empty texts have none and stay."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards their sources' target weights and globally shuffled; null sources are a source."""
    return mix(docs, told=False)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of all rows in doc_id order, and the index read back from them: doc_id, start, n_tokens, ids_crc32, shard."""
    return encode_documents(docs, tokenizer_path(), END_ID)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: SQL has neither the tokenizer nor the shingles' 64-bit hash; tests/llm hold the stages' operators against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    space = Workspace(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs, _ = space.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
