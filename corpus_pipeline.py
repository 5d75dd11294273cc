"""A corpus pipeline: the stages applied to ``documents``, each to what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import bpe, near_dedup, quality, secret_scan
from salesmart.llm import decontamination as decon
from salesmart.llm.common import read_table
from salesmart.session import scratch_uri


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines."""
    return quality.clean_good_documents(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the one with the smallest doc_id.

    Near duplicates share four fifths of their five-word shingles. Rows without
    a doc_id and rows of a repeated one are documents like any other.
    """
    return near_dedup.drop_near_duplicate_rows(docs, k=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, each row judged by its own text."""
    return decon.drop_contaminated_rows(docs, read_table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secret_scan.redact_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and digests of ids and decoded text."""
    return bpe.bpe_digest(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe", bpe_stage),
]

#: MinHash buckets, edit distance, lexing and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each stage's result is a table in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_uri(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
