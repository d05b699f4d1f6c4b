"""A corpus cleaning pipeline of training-data operators.

documents -> those whose language can be told -> one of each text -> one of each group of near-duplicates -> secrets
replaced -> packed into training sequences.  Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weighline.llm import exact_dedup, language_id, near_dedup, queries, secrets
from weighline.session import shared_dir


def told_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs)


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, size=5, percent=80)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed(docs)


STAGES = [("language", told_language), ("exact", one_of_each_text), ("near", one_of_each_group), ("secrets", without_secrets), ("packing", packed)]
#: Near-duplicates and best-fit packing cannot be stated in SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again for the next."""
    folder = f"{shared_dir(spark)}/weighline/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{k}-{name}")
        docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
