"""Corpus pipeline: documents through five operators of tidemart.llm.

Each stage works on all rows that the one before it kept; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontaminate, importance, ngram_join, packing, secret_scan
from tidemart.llm.common import stored, table


def resample_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes."""
    return importance.resample(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return ngram_join.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every found secret replaced by a mark."""
    return secret_scan.redact(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts with their bins."""
    return packing.pack(docs)


STAGES = [
    ("quality", resample_quality),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack_windows),
]

# Hashed n-gram models, secret spans and best-fit bins cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
