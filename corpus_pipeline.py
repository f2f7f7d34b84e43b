"""A corpus pipeline: quality, near-duplicates, secrets, mixing, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from logforge.llm import mixing, packing, quality, secret_scan, simhash  # noqa: E402
from logforge.session import configure, staged  # noqa: E402


def rate_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go."""
    configure(spark)
    ratings = quality.grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.rate(docs, ratings).filter("keep").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    configure(spark)
    return simhash.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    configure(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of documents near the target weights of sources, languages and topics."""
    configure(spark)
    return mixing.mix(docs).filter("kept").select(docs.columns)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the remaining documents in length buckets and batches."""
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", rate_quality),
    ("near_copies", drop_near_copies),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: Models, hashes and a tokenizer are not for SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
