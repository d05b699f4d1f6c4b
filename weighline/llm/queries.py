"""Queries of the training-data operators, with the parameters used in production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weighline.llm import (bpe, common as C, exact_dedup, language_id, language_model, near_dedup, order_minhash, packing, periodic_runs,
                           repeats, secrets, token_alignment, token_files, url_filter)

WORD_TOKENIZER, BYTE_TOKENIZER = "word_bpe_49k.json", "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
END_ID, SEQUENCE_TOKENS = 1, 4096
URL_RULES = [url_filter.Rule(*r) for r in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
                                           ("block", "net/es/"), ("block", "net/fr/"))]

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_tokens(C.documents(spark, sf_dir), C.scratch(spark, "token-files"),
                                     public_tokenizers.path(WORD_TOKENIZER), END_ID)
    return token_files.read_tokens(spark, files)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(C.documents(spark, sf_dir))[0]


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(C.documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict(C.documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(C.documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_next(C.documents(spark, sf_dir))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score(C.documents(spark, sf_dir))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), END_ID, SEQUENCE_TOKENS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(C.documents(spark, sf_dir))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(C.documents(spark, sf_dir), public_tokenizers.path(BYTE_TOKENIZER))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(C.documents(spark, sf_dir))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(C.documents(spark, sf_dir), periodic_runs.planted))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.compare(C.documents(spark, sf_dir), public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECE_MODEL))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.seed_labels(spark))
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES, model)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_files, op2_exact_dedup, op3_secrets, op4_language_id, op5_near_dedup, op6_order_minhash, op7_language_model, op8_packing,
    op9_bpe, op10_repeats, op11_periodic_runs, op12_token_alignment, op13_url_filter)}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
