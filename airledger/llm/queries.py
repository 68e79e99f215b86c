"""Registered queries opN_<name>: each operator over its whole table, with production parameters.

oracle.py has DuckDB SQL for those that SQL can express; the others are tested against
brute-force versions in tests/llm.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm import (byte_bpe, decontaminate, hard_negatives, langid, licenses, pii_crf, quality_rules, sharding, simhash, spelling,
                           toxicity, url_filter, warc)
from airledger.llm.common import table

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.pii_report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hit_spans")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), "doc_id", "text")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.train(url_filter.seed_urls(spark)))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label, lambda key: key % 50 == 0)


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_pii, op3_decontaminate, op4_byte_bpe, op5_language_id, op6_quality_rules, op7_sharding,
                                   op8_url_filter, op9_simhash, op10_toxicity, op11_spelling, op12_hard_negatives, op13_licenses)}
