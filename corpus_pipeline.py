"""The corpus pipeline: documents through quality rules, near-duplicate removal, benchmark
decontamination, masking of personal data, and byte-level BPE.

Each stage reads what its predecessor wrote, decides over all of it, and all but the last return
the columns of documents. The stages' own modules state what they do with nulls, empty and very
long texts, repeated rows, empty tables and extra columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from airledger.llm import byte_bpe, decontaminate, pii_crf, quality_rules, simhash
from airledger.llm.common import stored, table
from airledger.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_crf.mask_personal_data(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [("quality_rules", quality), ("simhash_near_dedup", near_duplicates), ("benchmark_decontamination", decontaminated),
          ("pii", personal_data), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The thresholds of exact binomial bounds, the fingerprints and the CRF have no form in SQL.
ORACLE_SQL = None
