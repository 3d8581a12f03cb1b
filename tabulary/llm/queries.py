"""The operators as registered queries over whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bagminhash, bpe, chat, collocations, decontaminate, langid, oracles, pii, quality, runs, secrets, sharding, toxicity
from .common import table


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_pii(table(spark, folder, "documents")).drop("redacted")


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    return chat.render(table(spark, folder, "conversations"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, folder, "documents"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.find_secrets(table(spark, folder, "documents")).drop("masked")


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.find_runs(table(spark, folder, "documents"), stretched=True).drop("collapsed")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_nearest": op2_nearest,
    "op3_language_id": op3_language_id,
    "op4_decontaminate": op4_decontaminate,
    "op5_chat": op5_chat,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_bpe": op10_bpe,
    "op11_sharding": op11_sharding,
    "op12_runs": op12_runs,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": oracles.LEAKS,
    "op5_chat": oracles.CHAT,
    "op6_near_duplicates": oracles.NEAR_DUPLICATES,
    "op11_sharding": oracles.SHARDS,
    "op13_collocations": oracles.COLLOCATIONS,
}
