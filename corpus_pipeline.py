"""Corpus pipeline: quality rules, line dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; every result is written as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farpoint.llm.bpe import encode_digest
from farpoint.llm.line_dedup import dedup_lines
from farpoint.llm.mixing import mixed_documents
from farpoint.llm.quality_rules import filter_documents
from farpoint.llm.simhash_dedup import keep_one
from farpoint.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that also stand earlier."""
    return dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each near-copy component (4-word shingles, 4 bits)."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them."""
    return mixed_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document of the mix."""
    return encode_digest(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("mixing", mixing),
    ("bpe", bpe),
]

# SimHash fingerprints and BPE can't be written in SQL; tests/llm compares run() with
# a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``STAGES`` over ``documents``, each stage written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
