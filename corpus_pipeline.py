"""The corpus pipeline: toxicity, near-duplicates, benchmark leaks, secrets, then tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulary.llm import bagminhash, bpe, decontaminate, secrets, toxicity
from tabulary.llm.common import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; null and empty texts are scored as texts without terms, an empty table stays empty."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return bagminhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, null and empty texts and repeated rows too; secrets in their texts are masked and n_chars follows."""
    return secrets.mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the texts that are left, one row a document; a null text counts as empty."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", keep_one),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
