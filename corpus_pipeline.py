"""Corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm import bpe, decontam, lines, ngram_join, quality
from riskframe.session import checkpoint_root


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_documents(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows."""
    return lines.line_dedup(docs, counts=False)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near duplicates."""
    return ngram_join.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the documents' token ids and of what they decode to."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", token_stage),
]

#: Merges of byte pairs can't be stated in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{base}/{k}-{name}")
    return docs
