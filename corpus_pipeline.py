"""From raw documents to tokens: language ID, exact and near de-duplication, decontamination, BPE.

Each stage is one operator of ``starforge.llm``. Its result is written as Parquet to the shared work folder and read
again as the next stage's ``docs``; all but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starforge.llm import bpe, decontaminate, exact_dedup, langid, simhash
from starforge.llm.common import table
from starforge.llm.queries import tokenizer_path
from starforge.session import work_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a known language (no letters, or no language leads)."""
    return langid.identify_and_keep(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component (3-word shingles, at most 2 bits)."""
    return simhash.keep_one(docs, words=3, budget=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that leak a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode what is left: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.token_digests(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", tokens),
]

#: Language model, fingerprints and merges can't be stated in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, "pipeline", f"{name}-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
