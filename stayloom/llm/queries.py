"""The operators bound to the given tables, each over the whole of them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayloom.llm import (
    bpe,
    conversations,
    exact_dedup,
    fingerprints,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
    whitening,
)
from stayloom.llm.frames import documents, shared_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(documents(spark, folder), documents(spark, folder, "labels"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(documents(spark, folder), BYTE_BPE)


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, folder))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(documents(spark, folder))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(documents(spark, folder))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.digest(documents(spark, folder), documents(spark, folder, "labels"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digest(documents(spark, folder), WORD_BPE)


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    store = f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}"
    return token_counts.digest(documents(spark, folder), store, BYTE_BPE, "byte_bpe_50k")


def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.digest(documents(spark, folder))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.digest(documents(spark, folder))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.digest(documents(spark, folder, "embeddings"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.digest(documents(spark, folder, "conversations"))


def op13_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.digest(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_packing,
        op3_suffix_dedup,
        op4_quality_rules,
        op5_substring_dedup,
        op6_quality_classifier,
        op7_bpe,
        op8_token_counts,
        op9_minhash,
        op10_exact_dedup,
        op11_whitening,
        op12_conversation_repair,
        op13_fingerprints,
    )
}

ORACLES: dict[str, str] = {"op10_exact_dedup": exact_dedup.SQL}
