"""From raw documents to packed sequences: five stages, each written and read again.

toxicity -> exact_dedup -> near_dedup -> substring_dedup -> packing.  All but the last return the columns of
`documents`; every stage works on all rows its predecessor kept, and an empty table passes through.
Null texts are empty ones: they are clean, equal to each other, and one of them is packed.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.llm import exact_dedup, minhash, packing, substring_dedup, toxicity
from stayloom.llm.frames import documents, settle
from stayloom.session import drop_settled, settled_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left: dict[tuple[str, str, str], list[str]] = {}


def after(before: str | None) -> Callable[[Stage], Stage]:
    """A stage that begins by deleting what the stage before it has settled on the way.

    A stage's input is its predecessor's result, written; the predecessor's own tables are then read by no one.
    """

    def made(stage: Stage) -> Stage:
        @functools.wraps(stage)
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            session = spark.sparkContext.applicationId
            drop_settled(spark, _left.pop((session, sf_dir, before), []))
            known = len(settled_tables())
            out = stage(spark, docs, sf_dir)
            _left[session, sf_dir, stage.__name__] = settled_tables()[known:]
            return out

        return run

    return made


@after(None)
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator, fitted on the labels, doesn't call toxic."""
    labels = documents(spark, sf_dir, "labels")
    scored = toxicity.toxicity(docs, labels, toxicity.usable(), keep_text=True)
    return scored.where("predicted = 0").select(*docs.columns)


@after("drop_toxic")
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.kept_documents(docs)


@after("drop_copies")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.kept_documents(docs)


@after("drop_near_copies")
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; n_chars is that of the new text."""
    cut = substring_dedup.substring_dedup(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@after("cut_repeats")
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

#: Learnt scores and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
