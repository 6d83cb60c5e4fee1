"""Windows, cohort selection, outcomes and table checks over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayloom.config import TrainingConfig
from stayloom.driver.linkage import (
    IMAGE_INDEX,
    IMAGE_INDEX_VIEWS,
    index,
    written_discharge_link,
    written_link,
    written_radiology_link,
)
from stayloom.driver.registry import query
from stayloom.driver.views import Views
from stayloom.functions.values import band
from stayloom.operators import checks, cohort, images, notes, outcomes, windows
from stayloom.operators.joins import restrict
from stayloom.operators.linkage import IMAGE
from stayloom.session import settle, tune

BASE_COLUMNS = [
    "subject_id", "hadm_id", "stay_id", "admission_type", "admission_location", "discharge_location",
    "first_careunit", "last_careunit", "admittime", "dischtime", "edregtime", "edouttime", "intime", "outtime",
    "los", "hospital_expire_flag", "deathtime", "dod", "gender", "race", "marital_status", "language",
    "insurance", "earliest_intime",
]


def base(v: Views):
    return windows.stay_base(v["icustays"], v["admissions"], v["patients"])


@query("stay_base", f"SELECT {', '.join(BASE_COLUMNS)}, CAST(age AS INTEGER) AS age FROM base", ["base"])
def _(v: Views):
    return base(v).select(*BASE_COLUMNS, "age")


def _windows_sql(start: int, end: int) -> str:
    return f"""
        SELECT stay_id, greatest(intime + to_hours({start}), earliest_intime) AS start_time,
               least(intime + to_hours({end}), outtime) AS end_time
        FROM base"""


@query("stay_windows", _windows_sql(-6, 48), ["base"])
def _(v: Views):
    return windows.stay_windows(base(v), -6, 48).select("stay_id", "start_time", "end_time")


@query("stay_windows_open", "SELECT stay_id, earliest_intime AS start_time, outtime AS end_time FROM base", ["base"])
def _(v: Views):
    return windows.stay_windows(base(v)).select("stay_id", "start_time", "end_time")


@query(
    "windowed_events",
    f"""SELECT c.* FROM chartevents c JOIN ({_windows_sql(0, 24)}) w ON c.stay_id = w.stay_id
        WHERE c.charttime > w.start_time AND c.charttime < w.end_time""",
    ["base", "chartevents"],
)
def _(v: Views):
    return windows.in_window(v["chartevents"], windows.stay_windows(base(v), 0, 24), ["stay_id"], "charttime")


# --- cohort -------------------------------------------------------------------------------------


def radiology(v: Views):
    return notes.radiology_notes(v["radiology"], written_radiology_link(v), v.windows)


def discharge(v: Views):
    return notes.discharge_notes(v["discharge"], written_discharge_link(v))


def presence(v: Views):
    """Counted from the images in their windows: paths and findings add no row."""
    taken = v.timed_metadata.select(*IMAGE, "StudyDatetime")
    found = images.images_in_windows(taken, written_link(v), v.windows)
    return cohort.modality_presence(v.windows, v.series, found, discharge(v), radiology(v))


RADIOLOGY = """
    SELECT l.stay_id, n.* FROM radiology n
    JOIN link_radiology l ON n.subject_id = l.subject_id AND n.hadm_id = l.hadm_id AND n.note_id = l.note_id
    JOIN windows w ON l.stay_id = w.stay_id
    WHERE n.charttime > w.start_time AND n.charttime < w.end_time"""
DISCHARGE = """
    SELECT l.stay_id, n.* FROM discharge n
    JOIN link_discharge l ON n.subject_id = l.subject_id AND n.hadm_id = l.hadm_id AND n.note_id = l.note_id"""
PRESENCE = f"""
    SELECT w.stay_id, coalesce(t.n, 0) AS n_ts, coalesce(i.n, 0) AS n_img,
           coalesce(d.n, 0) + coalesce(r.n, 0) AS n_text
    FROM windows w
    LEFT JOIN (SELECT stay_id, count(*) AS n FROM series GROUP BY stay_id) t ON w.stay_id = t.stay_id
    LEFT JOIN (SELECT stay_id, count(*) AS n FROM ({IMAGE_INDEX}) GROUP BY stay_id) i ON w.stay_id = i.stay_id
    LEFT JOIN (SELECT stay_id, count(*) AS n FROM ({DISCHARGE}) GROUP BY stay_id) d ON w.stay_id = d.stay_id
    LEFT JOIN (SELECT stay_id, count(*) AS n FROM ({RADIOLOGY}) GROUP BY stay_id) r ON w.stay_id = r.stay_id"""
PRESENCE_VIEWS = ["windows", "series", *IMAGE_INDEX_VIEWS, "discharge", "link_discharge", "link_radiology"]
INCLUDED = f"""
    SELECT w.stay_id FROM windows w JOIN ({PRESENCE}) m ON w.stay_id = m.stay_id
    WHERE w.age BETWEEN 25 AND 85 AND w.los >= 2 AND m.n_text > 0"""
CONFIG = TrainingConfig(age_lower=25, age_upper=85, los_lower=2, drop_missing_text=True)


SELECTED = ["hadm_id", "stay_id", "start_time", "end_time", "age", "los"]


def included(v: Views):
    return cohort.included_stays(v.windows, presence(v), CONFIG)


@query("notes_discharge", DISCHARGE, ["discharge", "link_discharge"])
def _(v: Views):
    return discharge(v)


@query("notes_radiology", RADIOLOGY, ["radiology", "link_radiology", "windows"])
def _(v: Views):
    return radiology(v)


@query("modality_presence", PRESENCE, PRESENCE_VIEWS)
def _(v: Views):
    v.write_stays()
    v.write_windows(*SELECTED)
    return presence(v)


@query("cohort_select", INCLUDED, PRESENCE_VIEWS)
def _(v: Views):
    v.write_stays()
    v.write_windows(*SELECTED)
    return included(v)


@query(
    "cohort_counts",
    f"SELECT (SELECT count(*) FROM windows) AS n_total, (SELECT count(*) FROM ({INCLUDED})) AS n_included",
    PRESENCE_VIEWS,
)
def _(v: Views):
    v.write_stays()
    v.write_windows(*SELECTED)
    return cohort.cohort_counts(v.windows, included(v))


# --- outcomes -----------------------------------------------------------------------------------

READMISSION = """
    CAST(w.stay_id IN (SELECT a.stay_id FROM windows a JOIN windows later USING (subject_id)
        WHERE later.intime > a.intime AND later.intime - to_days(30) <= a.outtime) AS INTEGER) AS readmission"""
OUTCOMES = f"""
    SELECT w.stay_id,
           CAST(coalesce(hospital_expire_flag, 1) <> 0 AND coalesce(
               coalesce(deathtime, dod) > intime AND coalesce(deathtime, dod) < outtime, false) AS INTEGER) AS icu_expire_flag,
           CAST(w.los > 3 AS INTEGER) AS los_binary, {READMISSION}
    FROM windows w"""


@query("outcomes", OUTCOMES, ["windows"])
def _(v: Views):
    return outcomes.outcomes(v.windows)


@query("readmission_window", f"SELECT w.stay_id, {READMISSION} FROM windows w", ["windows"])
def _(v: Views):
    return outcomes.readmission(v.windows)


@query(
    "export_included",
    f"""SELECT w.subject_id, w.hadm_id, w.stay_id, CAST(w.age AS INTEGER) AS age, w.gender, w.los,
               o.icu_expire_flag, o.los_binary, o.readmission
        FROM windows w JOIN ({OUTCOMES}) o ON w.stay_id = o.stay_id
        WHERE w.stay_id IN ({INCLUDED})""",
    PRESENCE_VIEWS,
)
def _(v: Views):
    tune(v.spark, lean=True)
    v.write_stays()
    v.write_windows("subject_id", *SELECTED, "gender", "intime", "outtime", "deathtime", "dod", "hospital_expire_flag")
    # Written before the joins: each filter of a plan stands on the driver as long as the plan runs.
    chosen = v.once("written_included", lambda: settle(included(v)))
    tabular = v.windows.select("subject_id", "hadm_id", "stay_id", "age", "gender", "los")
    return restrict(tabular.join(outcomes.outcomes(v.windows), "stay_id"), chosen, ["stay_id"]).select(
        "subject_id", "hadm_id", "stay_id", "age", "gender", "los", "icu_expire_flag", "los_binary", "readmission"
    )


@query(
    "fanout_audit",
    f"""SELECT t.table_name, n_rows, n_keys, round(n_rows / n_stays, 6) AS rows_per_stay,
               CAST(n_rows > n_keys AS INTEGER) AS fan_out
        FROM (SELECT 'time_series' AS table_name, count(*) AS n_rows, count(DISTINCT stay_id) AS n_keys FROM series
              UNION ALL SELECT 'cxr_index', count(*), count(DISTINCT dicom_id) FROM ({IMAGE_INDEX})
              UNION ALL SELECT 'notes_discharge', count(*), count(DISTINCT note_id) FROM ({DISCHARGE})
              UNION ALL SELECT 'notes_radiology', count(*), count(DISTINCT note_id) FROM ({RADIOLOGY})) t,
             (SELECT count(*) AS n_stays FROM windows)""",
    PRESENCE_VIEWS,
)
def _(v: Views):
    tune(v.spark, lean=True)
    v.write_stays()
    v.write_windows(*SELECTED)
    tables = {
        "time_series": (v.series, "stay_id"),
        "cxr_index": (index(v), "dicom_id"),
        "notes_discharge": (discharge(v), "note_id"),
        "notes_radiology": (radiology(v), "note_id"),
    }
    audit = cohort.fan_out_audit(tables, v.windows.count())
    return audit.withColumn("rows_per_stay", F.round("rows_per_stay", 6))


@query(
    "age_band",
    """SELECT CASE WHEN age <= 65 THEN 'Age<=65' WHEN age <= 85 THEN '65<Age<=85' ELSE 'Age>85' END AS age_group,
              count(*) AS n_stays FROM base GROUP BY age_group""",
    ["base"],
)
def _(v: Views):
    return base(v).groupBy(band("age").alias("age_group")).agg(F.count(F.lit(1)).alias("n_stays"))


# --- checks -------------------------------------------------------------------------------------

_ORDER_COLUMNS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
_ROW_TEXT = " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in _ORDER_COLUMNS)


@query(
    "table_fingerprint",
    f"""SELECT count(*) AS n_rows,
               CAST(sum(CAST(('0x' || substr(md5({_ROW_TEXT}), 1, 15)) AS BIGINT)) AS VARCHAR) AS hash_sum
        FROM orders""",
)
def _(v: Views):
    return checks.fingerprint(v["orders"])


@query(
    "multiset_difference",
    """WITH a AS (SELECT * FROM lineitem), b AS (SELECT * REPLACE ('R' AS l_returnflag) FROM lineitem)
       SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS only_a,
              (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS only_b""",
)
def _(v: Views):
    a = v["lineitem"]
    return checks.difference(a, a.withColumn("l_returnflag", F.lit("R")))
