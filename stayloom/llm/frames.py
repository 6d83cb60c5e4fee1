"""Columns and tables shared by the operators."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.session import settle, shared_folder, tune

__all__ = ["documents", "packed", "ready", "settle", "shared_folder", "unpacked"]

#: Rows an Arrow batch may have; long texts then make batches of some megabytes.
ROWS = "512"


def ready(spark: SparkSession) -> SparkSession:
    """Settings of the operators. Python workers of a local session get the package from the driver;
    a cluster has it installed or is given it with --py-files."""
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        spark.sparkContext.addFile(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), recursive=True)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS)
    return tune(spark)


def documents(spark: SparkSession, folder: str, name: str = "documents") -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def packed(docs: DataFrame, text: str = "text", id: str = "doc_id", text_type: str = "string") -> DataFrame:
    """(in_id, in_text, rest): the id, the text (null is empty), and a struct of all columns but the text.

    Whatever other columns there are, their names cannot clash with those an operator adds.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    return docs.select(
        F.col(f"`{id}`").cast("long").alias("in_id"),
        F.coalesce(F.col(f"`{text}`").cast(text_type), F.lit("").cast(text_type)).alias("in_text"),
        F.struct(*(rest or [F.lit(0).alias("none")])).alias("rest"),
    )


def unpacked(df: DataFrame, columns: Sequence[str], replaced: dict[str, Column]) -> DataFrame:
    """`columns` in order, each from `rest` unless replaced; further replacements follow."""
    kept = [replaced.get(c, F.col(f"rest.`{c}`")).alias(c) for c in columns]
    return df.select(*kept, *[v.alias(k) for k, v in replaced.items() if k not in columns])


def survivors(docs: DataFrame, keys: dict[str, Column], decided: DataFrame) -> DataFrame:
    """The rows of `docs` that `decided` keeps; it has the columns `keys` and a boolean `kept`.

    Of rows that agree in all keys, of which some are kept and some not, one stays.
    """
    names = list(keys)
    lost = decided.where("NOT kept").select(*names)
    won = decided.where("kept").select(*names)
    gone = lost.join(won, names, "left_anti")
    twice = settle(lost.join(won, names, "left_semi").distinct())
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[v.alias(k) for k, v in keys.items()])
    left = keyed.join(gone, names, "left_anti")
    if not twice.isEmpty():
        left = left.join(twice, names, "left_anti").unionByName(left.join(twice, names, "left_semi").dropDuplicates(names))
    return left.select("row.*")
