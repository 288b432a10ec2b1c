"""A training-data pipeline over ``documents``: STAGES in order, each one reading what the one before kept.

A stage's scratch tables belong to the frame that it returns: they are deleted
once nothing can read that frame any more, and not before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import exact_dedup, packing, quality_rules, secret_scan, simhash
from tickweave.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their rules or their host reject go."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one document stays."""
    return simhash.near_dedup(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind."""
    return secret_scan.redact(docs, secret_scan.new_ledger(spark))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("secret_scan", secrets), ("best_fit_packing", pack)]

#: Fingerprints, components and tokens are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return docs
