"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchpath.llm import mixing, packing, pii, quality_rules, simhash
from touchpath.llm.common import table, written
from touchpath.llm.queries import MIX_SEED, PII_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (SimHash, three words, two bits) stays."""
    return simhash.keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates."""
    return pii.replace_private(docs, PII_KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their targets; texts are repeated or cut by what is taken."""
    return mixing.mixed_texts(docs, MIX_SEED)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into sequences; one row per piece."""
    return packing.packed(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mix", mixed),
    ("pack", packed),
]

# Fingerprints (XXH64), keyed surrogates and tokenizers are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
