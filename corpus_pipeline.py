"""Cleaning pipeline over ``documents``: five stages, each written as Parquet
and read again by the next.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import shared_path, table
from tidewater.llm.exact_dedup import drop_duplicates
from tidewater.llm.ngram_join import drop_near_duplicates
from tidewater.llm.packing import pack_documents
from tidewater.llm.pii import redact
from tidewater.llm.quality_gam import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest doc_id stays."""
    return drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 5-word shingles at Jaccard 0.8, the smallest doc_id stays."""
    return drop_near_duplicates(docs, words=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; no document goes."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii), ("packing", packing)]
ORACLE_SQL = None  # classifier, components, span model and packing are not SQL; tests/llm holds brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out, path = stage(spark, docs, sf_dir), shared_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
