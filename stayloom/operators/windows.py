"""Stays with demographics and their observation windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from stayloom.functions import times
from stayloom.functions.values import quoted


def stay_base(
    icustays: DataFrame, admissions: DataFrame, patients: DataFrame, debug_limit: int | None = None
) -> DataFrame:
    """One row per stay: admission, patient, age and earliest arrival."""
    stays = icustays.select(
        "subject_id", "hadm_id", "stay_id", "first_careunit", "last_careunit", "intime", "outtime", "los"
    )
    visits = admissions.select(
        "subject_id", "hadm_id", "admission_type", "admission_location", "discharge_location",
        "admittime", "dischtime", "edregtime", "edouttime", "hospital_expire_flag", "deathtime",
        "race", "marital_status", "language", "insurance",
    )
    people = patients.select("subject_id", "dod", "gender", "anchor_age", "anchor_year")
    base = stays.join(visits, ["subject_id", "hadm_id"]).join(people, ["subject_id"])
    base = base.withColumn("age", times.age_at("admittime")).withColumn(
        "earliest_intime", times.earliest("intime", "admittime", "edregtime")
    )
    return base if debug_limit is None else base.orderBy("stay_id").limit(debug_limit)


def stay_windows(base: DataFrame, start_diff: int | None = None, end_diff: int | None = None) -> DataFrame:
    """Add start_time and end_time from signed hour offsets to ICU admission."""
    return base.withColumns(
        {"start_time": times.window_start(start_diff), "end_time": times.window_end(end_diff)}
    )


def in_window(
    events: DataFrame, windows: DataFrame, on: Sequence[str], at: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Events strictly between start_time and end_time of their stay."""
    bounds = windows.select(*on, "start_time", "end_time")
    kept = columns or events.columns
    return events.join(bounds, list(on)).where(times.inside(at)).select(*[quoted(c) for c in kept])
