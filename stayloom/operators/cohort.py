"""Which stays enter the training set, and checks on its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.config import TrainingConfig
from stayloom.session import settle


def modality_presence(
    windows: DataFrame, series: DataFrame, images: DataFrame, discharge: DataFrame, radiology: DataFrame
) -> DataFrame:
    """Rows per stay in each modality, 0 where there are none.

    All tables are one table of (stay, marker) and added up together, so that stays are shuffled once
    and a stay with very many rows sends one sum per task.  The stays of each table are written by
    themselves: in one plan the filters of all tables' joins would stand on the driver at once.
    """
    names = ["_stays", "n_ts", "n_img", "n_text"]

    def marked(df: DataFrame, name: str) -> DataFrame:
        return df.select("stay_id", *[F.lit(int(n == name)).cast("bigint").alias(n) for n in names])

    together = marked(windows, "_stays")
    for df, name in ((series, "n_ts"), (images, "n_img"), (discharge, "n_text"), (radiology, "n_text")):
        together = together.unionByName(marked(settle(df.select("stay_id")), name))
    counts = together.groupBy("stay_id").agg(*[F.sum(n).alias(n) for n in names])
    return counts.where("_stays > 0").drop("_stays")


def included_stays(windows: DataFrame, presence: DataFrame, config: TrainingConfig) -> DataFrame:
    """Stays within the age and length bounds that have the required modalities."""
    wanted = F.col("age").between(config.age_lower, config.age_upper) & (F.col("los") >= config.los_lower)
    for required, count in (
        (config.drop_missing_ts, "n_ts"),
        (config.drop_missing_img, "n_img"),
        (config.drop_missing_text, "n_text"),
    ):
        if required:
            wanted = wanted & (F.col(count) > 0)
    return windows.select("stay_id", "age", "los").join(presence, "stay_id").where(wanted).select("stay_id")


def cohort_counts(windows: DataFrame, included: DataFrame) -> DataFrame:
    """Number of stays, and of those included, in one row."""
    flags = windows.select("stay_id").join(
        included.select("stay_id").withColumn("_in", F.lit(1)), "stay_id", "left"
    )
    return flags.agg(F.count(F.lit(1)).alias("n_total"), F.count("_in").alias("n_included"))


def fan_out_audit(tables: dict[str, tuple[DataFrame, str]], n_stays: int) -> DataFrame:
    """Rows, distinct keys and rows per stay of each table; more rows than keys points at a fan-out.

    Each table is counted by itself: in one plan the filters of all tables' joins would stand on the driver at once.
    """
    audits = []
    for name, (df, key) in tables.items():
        counts = settle(df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_keys")))
        audits.append(
            counts.select(
                F.lit(name).alias("table_name"),
                "n_rows",
                "n_keys",
                (F.col("n_rows") / n_stays if n_stays else F.lit(0.0)).alias("rows_per_stay"),
                (F.col("n_rows") > F.col("n_keys")).cast("int").alias("fan_out"),
            )
        )
    together = audits[0]
    for audit in audits[1:]:
        together = together.unionByName(audit)
    return together
