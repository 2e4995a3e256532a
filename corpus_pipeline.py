"""A corpus pipeline of four stages over ``documents``: quality rules, near-duplicate removal,
secret redaction, packing.

Each stage takes (spark, docs, sf_dir), with docs the rows its predecessor kept, and returns
a DataFrame; ``run`` writes each result as Parquet to the shared folder and reads it back as the
next stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quirework.llm.common import materialize
from quirework.llm.hostrules import filter_documents
from quirework.llm.minhash import deduplicate
from quirework.llm.packing import added_tokens, pack_documents
from quirework.llm.secretscan import redact_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or whose source is rejected, go.

    Null texts have no words and go; clean documents stay as they are.
    """
    return filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) the smallest doc_id stays."""
    return deduplicate(docs, width=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark and ``n_chars`` follows; every document stays."""
    return redact_documents(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 1024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    return pack_documents(docs, path, public_tokenizers.PATTERN, added, size=1024).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("packing", packing),
]

#: SQL can't express the tokenizer of the last stage; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
