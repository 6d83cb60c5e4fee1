"""Declared columns of the source tables, used when a table comes as CSV.

Only the columns the work names are listed, with the types it relies on; a CSV column that is
not listed is read as text.  Codes stay text, so that leading zeros survive.  Columns named like
dates or times are text here and are turned into timestamps by `coerce_datetimes`.
"""

from __future__ import annotations

from pyspark.sql import types as T

from stayloom.config import FINDINGS

_LONG = ["subject_id", "hadm_id", "stay_id", "itemid", "pharmacy_id", "study_id"]
_INT = [
    "anchor_age", "anchor_year", "hospital_expire_flag", "icd_version", "poe_seq", "emar_seq",
    "seq_num", "field_ordinal", "parent_field_ordinal", "StudyDate",
]
_DOUBLE = ["valuenum", "los", "StudyTime", *FINDINGS]

COLUMN_TYPES: dict[str, T.DataType] = {
    **{name: T.LongType() for name in _LONG},
    **{name: T.IntegerType() for name in _INT},
    **{name: T.DoubleType() for name in _DOUBLE},
}

# Free text with line breaks inside quotes; only these files cannot be split at line ends.
MULTI_LINE_TABLES = ["discharge", "radiology", "radiology_detail"]


def csv_schema(header: list[str]) -> T.StructType:
    """Schema for a CSV file with the given header."""
    return T.StructType(
        [T.StructField(name, COLUMN_TYPES.get(name, T.StringType())) for name in header]
    )
