"""From documents to packed training sequences: five stages, each an operator of its own.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; its
result is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeline.llm import jaccard_groups, packing, pseudonyms, quality_rules, suffix_dedup
from hazeline.llm.queries import BYTE_BPE, KEY, documents
from hazeline.scratch import new_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the least doc_id stays."""
    return jaccard_groups.one_of_each(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that stand earlier in the corpus are cut out."""
    return suffix_dedup.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to pseudonyms."""
    return pseudonyms.pseudonymised(docs, KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("pseudonyms", personal_data),
    ("packing", packed),
]

# Stages two to five can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        path = new_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
