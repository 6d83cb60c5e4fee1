"""Outcome flags of a stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.functions.times import days
from stayloom.operators.ordered import next_value


def icu_expire_flag() -> Column:
    """1 when the patient died strictly within the stay; deathtime counts before dod.

    A patient flagged as having left the hospital alive did not; an unknown flag leaves it to the times.
    """
    died = F.coalesce("deathtime", "dod")
    left_alive = F.coalesce(F.col("hospital_expire_flag") == 0, F.lit(False))
    within = (died > F.col("intime")) & (died < F.col("outtime"))
    return F.coalesce((~left_alive & within).cast("int"), F.lit(0))


def los_binary(los_range: float = 3) -> Column:
    """1 when the stay lasted longer than `los_range` days."""
    return F.when(F.col("los") > los_range, F.lit(1)).otherwise(F.lit(0))


def readmission(windows: DataFrame, readmission_range: int = 30) -> DataFrame:
    """(stay_id, readmission): 1 when the subject's next stay begins by outtime plus the range.

    Only the next intime of the subject matters: if any later one is early enough, it is.  The
    look-ahead runs over the distinct intimes, so a subject with very many stays is not compared
    with itself.
    """
    following = next_value(windows, ["subject_id"], "intime", "next_intime")
    back = F.col("next_intime") <= F.col("outtime") + days(readmission_range)
    return (
        windows.select("stay_id", "subject_id", "intime", "outtime")
        .join(following, ["subject_id", "intime"], "left")
        .select("stay_id", F.when(back, F.lit(1)).otherwise(F.lit(0)).alias("readmission"))
    )


def outcomes(windows: DataFrame, los_range: float = 3, readmission_range: int = 30) -> DataFrame:
    """Death in the ICU, long stay and readmission of every stay."""
    flags = windows.select(
        "stay_id", icu_expire_flag().alias("icu_expire_flag"), los_binary(los_range).alias("los_binary")
    )
    return flags.join(readmission(windows, readmission_range), "stay_id")
