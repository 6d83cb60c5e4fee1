"""Hospital-shaped tables derived from the given tables.

orders are stays and admissions, customers are patients, line items are images, events are vital
signs, documents are notes, conversations are note details, embeddings are image vectors.  Each
view is one SELECT; where Spark and the checking engine spell a function differently, the
text comes from a Dialect.  Some columns are NULL by rule, because the given tables have no NULLs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from stayloom.config import FINDINGS
from stayloom.functions.times import packed_datetime
from stayloom.operators.linkage import STAY, stays_with_admission
from stayloom.operators.timeseries import time_series
from stayloom.operators.windows import stay_base, stay_windows
from stayloom.session import settle

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# event type → vital sign
VITAL_OF = {
    "click": "Heart Rate",
    "error": "Respiratory Rate",
    "purchase": "Non Invasive Blood Pressure systolic",
    "signup": "Non Invasive Blood Pressure diastolic",
    "view": "Temperature Fahrenheit",
}
OBSERVED = list(VITAL_OF.values())
VITALS = [*OBSERVED, "GCS - Eye Opening"]  # the last one never occurs


@dataclass(frozen=True)
class Dialect:
    days: Callable[[str], str]
    hours: Callable[[str], str]
    hours_since_2024: Callable[[str], str]
    quotient: Callable[[str, int], str]


SPARK = Dialect(
    days=lambda n: f"make_dt_interval(CAST({n} AS INT))",
    hours=lambda n: f"make_dt_interval(0, CAST({n} AS INT))",
    hours_since_2024=lambda t: f"(unix_seconds(CAST({t} AS TIMESTAMP)) - 1704067200) div 3600",
    quotient=lambda a, b: f"({a}) div {b}",
)
DUCK = Dialect(
    days=lambda n: f"to_days(CAST({n} AS INTEGER))",
    hours=lambda n: f"to_hours(CAST({n} AS BIGINT))",
    hours_since_2024=lambda t: f"date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', {t})",
    quotient=lambda a, b: f"({a}) // {b}",
)


def _icustays(d: Dialect) -> str:
    return f"""
        SELECT o_custkey AS subject_id, o_orderkey + 1000000 AS hadm_id, o_orderkey AS stay_id,
               o_orderpriority AS first_careunit, o_orderstatus AS last_careunit,
               o_orderdate AS intime, o_orderdate + {d.days("o_orderkey % 10 + 1")} AS outtime,
               CAST(o_orderkey % 10 + 1 AS DOUBLE) AS los
        FROM orders"""


def _admissions(d: Dialect) -> str:
    return f"""
        SELECT o_custkey AS subject_id, o_orderkey + 1000000 AS hadm_id,
               o_orderpriority AS admission_type, 'FROM ' || o_orderstatus AS admission_location,
               CASE WHEN o_orderstatus = 'F' THEN 'DIED' ELSE 'HOME' END AS discharge_location,
               o_orderdate - {d.hours("o_orderkey % 7")} AS admittime,
               o_orderdate + {d.days("o_orderkey % 10 + 1")} + {d.hours("o_orderkey % 5")} AS dischtime,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate - {d.hours("o_orderkey % 48")} END AS edregtime,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + {d.hours("3")} END AS edouttime,
               CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END
                   AS hospital_expire_flag,
               CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + {d.hours("o_orderkey % 400")} END AS deathtime,
               CASE o_custkey % 6 WHEN 0 THEN 'WHITE - OTHER EUROPEAN' WHEN 1 THEN 'ASIAN - CHINESE'
                   WHEN 2 THEN 'HISPANIC OR BLACK' WHEN 3 THEN 'BLACK/AFRICAN AMERICAN'
                   WHEN 4 THEN 'PATIENT DECLINED' END AS race,
               CASE o_custkey % 4 WHEN 0 THEN 'MARRIED' WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'WIDOWED' END
                   AS marital_status,
               CASE WHEN o_custkey % 9 = 0 THEN '?' ELSE 'ENGLISH' END AS language,
               o_orderpriority AS insurance
        FROM orders"""


def _patients(d: Dialect) -> str:
    return f"""
        SELECT c_custkey AS subject_id,
               CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CAST(18 + c_custkey % 73 AS INT) AS anchor_age, CAST(1990 + c_custkey % 5 AS INT) AS anchor_year,
               CASE WHEN c_custkey % 3 = 0 THEN o_first + {d.days("c_custkey % 9")} END AS dod
        FROM customer
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS o_first FROM orders GROUP BY o_custkey) AS f
            ON c_custkey = o_custkey"""


def _chartevents(d: Dialect) -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in VITAL_OF.items())
    codes = " ".join(f"WHEN '{k}' THEN {220000 + i}" for i, k in enumerate(VITAL_OF))
    return f"""
        SELECT o_custkey AS subject_id, o_orderkey + 1000000 AS hadm_id, o_orderkey AS stay_id,
               CAST(CASE event_type {codes} END AS BIGINT) AS itemid, CASE event_type {names} END AS label,
               o_orderdate + {d.hours(d.hours_since_2024("ts"))} AS charttime, ts AS storetime,
               CASE WHEN event_id % 13 <> 0 THEN value END AS valuenum
        FROM events JOIN orders ON user_id = o_orderkey"""


def _metadata(d: Dialect) -> str:
    date = "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT)"
    return f"""
        SELECT o_custkey AS subject_id, l_orderkey AS study_id,
               CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) || '-'
                   || CAST(l_partkey AS VARCHAR(20)) || '-' || CAST(l_suppkey AS VARCHAR(20)) || '-'
                   || CAST({date} AS VARCHAR(20)) AS dicom_id,
               {date} AS "StudyDate",
               CAST(l_suppkey % 24 * 10000 + l_partkey % 60 * 100 + l_linenumber * 7 AS DOUBLE) + 0.25
                   AS "StudyTime",
               CASE l_linenumber % 4 WHEN 0 THEN 'AP' WHEN 1 THEN 'PA' WHEN 2 THEN 'LATERAL' END
                   AS "ViewPosition"
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _labeler(step: int, cycle: int) -> Callable[[Dialect], str]:
    def text(d: Dialect) -> str:
        findings = ", ".join(
            f"CASE (o_orderkey * {step} + {i}) % {cycle} WHEN 0 THEN 1.0E0 WHEN 1 THEN 0.0E0 WHEN 2 THEN -1.0E0 END"
            f' AS "{f}"'
            for i, f in enumerate(FINDINGS)
        )
        return f"SELECT o_custkey AS subject_id, o_orderkey AS study_id, {findings} FROM orders"

    return text


def _image_paths(d: Dialect) -> str:
    return """
        SELECT subject_id, study_id, dicom_id,
               'files/s' || CAST(study_id AS VARCHAR(20)) || '/' || dicom_id || '.dcm' AS path
        FROM cxr_metadata"""


def _report_paths(d: Dialect) -> str:
    return """
        SELECT o_custkey AS subject_id, o_orderkey AS study_id,
               'files/s' || CAST(o_orderkey AS VARCHAR(20)) || '.txt' AS path
        FROM orders"""


def _discharge(d: Dialect) -> str:
    return f"""
        SELECT 'DS-' || CAST(doc_id AS VARCHAR(20)) AS note_id, o_custkey AS subject_id,
               o_orderkey + 1000000 AS hadm_id, o_orderdate + {d.days("o_orderkey % 10 + 1")} AS charttime, text
        FROM documents JOIN orders ON doc_id = o_orderkey"""


def _radiology(d: Dialect) -> str:
    return f"""
        SELECT 'RR-' || CAST(doc_id AS VARCHAR(20)) AS note_id, o_custkey AS subject_id,
               o_orderkey + 1000000 AS hadm_id, o_orderdate + {d.hours("n_chars % 120 - 6")} AS charttime, text
        FROM documents JOIN orders ON {d.quotient("doc_id", 3)} = o_orderkey"""


def _radiology_detail(d: Dialect) -> str:
    return """
        SELECT 'RR-' || CAST(conv_id AS VARCHAR(20)) AS note_id, conv_id AS subject_id, role AS field_name,
               text AS field_value, CAST(CASE WHEN turn % 5 <> 4 THEN turn END AS INT) AS field_ordinal
        FROM conversations"""


def _stay_notes(d: Dialect) -> str:
    return "SELECT hadm_id - 1000000 AS stay_id, note_id, charttime, text FROM radiology"


def _predictions(d: Dialect) -> str:
    return """
        SELECT labels.doc_id AS stay_id, quality AS y_true, lang, source,
               CASE WHEN n_chars <= 500 THEN 'short' ELSE 'long' END AS size_group,
               CAST((n_chars * 7 + labels.doc_id * 13) % 71 + quality * 30 AS DOUBLE) / 100 AS y_prob
        FROM labels JOIN documents ON labels.doc_id = documents.doc_id"""


MIX_FACTORS = {"Baseline": 3, "Baseline+Image": 5, "Baseline+Text": 11, "Baseline+Image+Text": 17}


def _mix_predictions(d: Dialect) -> str:
    parts = [
        f"""SELECT labels.doc_id AS stay_id, 'fixed+vector+text' AS models, '{mix}' AS mix, quality AS y_true,
                   CAST((n_chars * {f} + labels.doc_id * 13) % 71 + quality * {10 + 2 * i} AS DOUBLE) / 100 AS y_prob
            FROM labels JOIN documents ON labels.doc_id = documents.doc_id"""
        for i, (mix, f) in enumerate(MIX_FACTORS.items())
    ]
    return " UNION ALL ".join(parts)


def _vectors(d: Dialect) -> str:
    return "SELECT label AS stay_id, vec_id, embedding FROM embeddings"


VIEWS: dict[str, tuple[list[str], Callable[[Dialect], str]]] = {
    "icustays": (["orders"], _icustays),
    "admissions": (["orders"], _admissions),
    "patients": (["customer", "orders"], _patients),
    "chartevents": (["events", "orders"], _chartevents),
    "cxr_metadata": (["lineitem", "orders"], _metadata),
    "cxr_chexpert": (["orders"], _labeler(1, 4)),
    "cxr_negbio": (["orders"], _labeler(3, 5)),
    "cxr_image_path": (["cxr_metadata"], _image_paths),
    "cxr_text_path": (["orders"], _report_paths),
    "discharge": (["documents", "orders"], _discharge),
    "radiology": (["documents", "orders"], _radiology),
    "radiology_detail": (["conversations"], _radiology_detail),
    "stay_notes": (["radiology"], _stay_notes),
    "predictions": (["labels", "documents"], _predictions),
    "mix_predictions": (["labels", "documents"], _mix_predictions),
    "vectors": (["embeddings"], _vectors),
}


class Views:
    """The given tables and the derived views as DataFrames, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in TABLES:
                self._known[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                needs, text = VIEWS[name]
                sql = text(SPARK).replace('"', "`")
                for need in needs:
                    sql = _replace_table(sql, need)
                self._known[name] = self.spark.sql(sql, **{need: self[need] for need in needs})
        return self._known[name]

    def table(self, **sources: DataFrame):
        """Keep derived frames under a name."""
        self._known.update(sources)
        return self

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A derived frame that is made when first asked for and kept under its name."""
        if name not in self._known:
            self._known[name] = make()
        return self._known[name]

    @cached_property
    def stays(self) -> DataFrame:
        return stays_with_admission(self["icustays"], self["admissions"])

    @cached_property
    def windows(self) -> DataFrame:
        """Every stay with the window from earliest arrival to outtime."""
        return stay_windows(stay_base(self["icustays"], self["admissions"], self["patients"]))

    def write_windows(self, *columns: str) -> None:
        """Write these columns of the windows once, where several steps of a query read them."""
        self.windows = self.once("written_windows", lambda: settle(self.windows.select(*columns)))

    def write_stays(self) -> None:
        """Write what links read of the stays once, where a query builds several links."""
        self.stays = self.once("written_stays", lambda: settle(self.stays.select(*STAY, "earliest_intime", "outtime")))

    @cached_property
    def series(self) -> DataFrame:
        return time_series(self["chartevents"], self.windows, VITALS)

    @cached_property
    def timed_metadata(self) -> DataFrame:
        """Image metadata with its timestamp.

        Not written: beside the link, which reads all of it once, each use needs linked rows only.
        """
        return self["cxr_metadata"].withColumn("StudyDatetime", packed_datetime("StudyDate", "StudyTime"))

    @cached_property
    def written_series(self) -> DataFrame:
        """The series as a written table, which is what features and texts read."""
        return settle(self.series)


def _replace_table(sql: str, name: str) -> str:
    """Point FROM and JOIN at the DataFrame passed under the table's name."""
    return re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}} AS {name}", sql)


def duck(name: str) -> str:
    return VIEWS[name][1](DUCK)


def with_views(sql: str, names: Sequence[str]) -> str:
    """Put the definitions of the named views, and of what they need, before a statement."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in TABLES or name in order:
            return
        for need in EXTRA[name][0] if name in EXTRA else VIEWS[name][0]:
            add(need)
        order.append(name)

    for name in names:
        add(name)
    if not order:
        return sql
    bodies = [f"{n} AS ({EXTRA[n][1] if n in EXTRA else duck(n)})" for n in order]
    text = sql.strip()
    joint = ",\n" if text[:5].upper() == "WITH " else "\n"
    rest = text[5:] if joint == ",\n" else text
    return "WITH " + ",\n".join(bodies) + joint + rest


def _pivot_cells() -> str:
    return ", ".join(
        f"first(valuenum ORDER BY storetime, itemid, valuenum NULLS FIRST) FILTER (WHERE label = '{v}') AS \"{v}\""
        for v in VITALS
    )


# Steps several checks share, in the checking engine's SQL only.
EXTRA: dict[str, tuple[list[str], str]] = {
    "stays": (
        ["icustays", "admissions"],
        """SELECT i.subject_id, i.hadm_id, i.stay_id, i.intime, i.outtime, a.admittime, a.dischtime, a.edregtime,
                  a.edouttime, least(i.intime, a.admittime, a.edregtime) AS earliest_intime
           FROM icustays i LEFT JOIN admissions a ON i.subject_id = a.subject_id AND i.hadm_id = a.hadm_id""",
    ),
    "image_times": (
        ["cxr_metadata"],
        """SELECT subject_id, study_id, dicom_id,
                  strptime(CAST("StudyDate" AS VARCHAR) || substr(printf('%010.3f', "StudyTime"), 1, 6),
                           '%Y%m%d%H%M%S') AS "StudyDatetime"
           FROM cxr_metadata""",
    ),
    "link_image": (
        ["stays", "image_times"],
        """SELECT DISTINCT s.subject_id, s.hadm_id, s.stay_id, m.study_id, m.dicom_id
           FROM stays s JOIN image_times m ON s.subject_id = m.subject_id
               AND m."StudyDatetime" >= s.earliest_intime AND m."StudyDatetime" <= s.outtime""",
    ),
    "link_discharge": (
        ["stays", "discharge"],
        """SELECT DISTINCT s.subject_id, s.hadm_id, s.stay_id, n.note_id
           FROM stays s JOIN discharge n ON s.subject_id = n.subject_id AND s.hadm_id = n.hadm_id""",
    ),
    "link_radiology": (
        ["stays", "radiology"],
        """SELECT DISTINCT s.subject_id, s.hadm_id, s.stay_id, n.note_id
           FROM stays s JOIN radiology n ON s.subject_id = n.subject_id AND s.hadm_id = n.hadm_id
               AND n.charttime >= s.earliest_intime AND n.charttime <= s.outtime""",
    ),
    "base": (
        ["icustays", "admissions", "patients"],
        """SELECT i.*, a.* EXCLUDE (subject_id, hadm_id), p.* EXCLUDE (subject_id),
                  p.anchor_age + (year(a.admittime) - p.anchor_year) AS age,
                  least(i.intime, a.admittime, a.edregtime) AS earliest_intime
           FROM icustays i JOIN admissions a ON i.subject_id = a.subject_id AND i.hadm_id = a.hadm_id
           JOIN patients p ON i.subject_id = p.subject_id""",
    ),
    "windows": (["base"], "SELECT *, earliest_intime AS start_time, outtime AS end_time FROM base"),
    "pivoted": (
        ["chartevents", "windows"],
        f"""SELECT c.hadm_id, c.stay_id, c.charttime, {_pivot_cells()}
            FROM chartevents c JOIN windows w ON c.hadm_id = w.hadm_id AND c.stay_id = w.stay_id
            WHERE c.label IN ({", ".join(f"'{v}'" for v in VITALS)})
                AND c.charttime > w.start_time AND c.charttime < w.end_time
            GROUP BY c.hadm_id, c.stay_id, c.charttime""",
    ),
    "series": (
        ["pivoted"],
        """SELECT *, date_diff('second', min(charttime) OVER (PARTITION BY stay_id), charttime) / 3600.0
               AS frac_charttime FROM pivoted""",
    ),
}
