"""From raw documents to packed token sequences, in five stages.

Each stage works on all rows that the one before kept, and is written before the next one reads
it. The first four return the columns of ``documents``; the last returns the packed pieces with
their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm.common import bound_batches, documents_of, written
from lectern.llm.exact_dedup import without_exact_duplicates
from lectern.llm.packing import pack_documents
from lectern.llm.quality import good_documents
from lectern.llm.secrets import without_secrets
from lectern.llm.simhash import without_near_duplicates


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return good_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_exact_duplicates(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_secrets(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, keep_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Hashes, entropies and tokens have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents_of(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = written(docs, name)
    return docs
