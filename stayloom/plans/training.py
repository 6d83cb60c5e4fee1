"""The training set: five tables of the included stays."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stayloom.config import METADATA_VARIABLES, TrainingConfig
from stayloom.functions.values import quoted
from stayloom.operators import cohort, images, notes, outcomes, timeseries, windows
from stayloom.operators.joins import restrict
from stayloom.operators.linkage import split_links
from stayloom.session import settle, tune
from stayloom.sources.folders import require
from stayloom.sources.sinks import written

INPUTS = [
    "list_ids", "admissions", "patients", "icustays", "chartevents", "cxr_metadata", "cxr_image_path",
    "cxr_text_path", "cxr_chexpert", "cxr_negbio", "dsnotes", "radnotes",
]

# table: (key whose repeats point at a fan-out, sort order of the export)
OUTPUTS = {
    "tabular": ("stay_id", []),
    "time_series": ("stay_id", ["stay_id", "charttime"]),
    "cxr_index": ("dicom_id", ["stay_id", "StudyDatetime"]),
    "notes_discharge": ("note_id", []),
    "notes_radiology": ("note_id", ["stay_id", "charttime"]),
}


@dataclass
class Training:
    """Tables of the build before the restriction to included stays."""

    windows: DataFrame
    tables: dict[str, DataFrame]
    presence: DataFrame
    included: DataFrame
    outcomes: DataFrame


def build_training(
    master: Mapping[str, DataFrame], config: TrainingConfig | None = None, keep: bool = True
) -> Training:
    """All tables of the training set from the master tables.

    With `keep` the windows and the four event tables are settled once: the cohort rule counts
    their rows, and the export reads them again.
    """
    config = config or TrainingConfig()
    held = settle if keep else (lambda df: df)
    links = split_links(master["list_ids"])

    base = windows.stay_base(master["icustays"], master["admissions"], master["patients"], config.debug_limit)
    stays = held(windows.stay_windows(base, config.start_diff, config.end_diff))

    series = held(timeseries.time_series(master["chartevents"], stays, config.vital_signs))
    index = held(
        images.image_index(
            master["cxr_metadata"], links["image"], stays, master["cxr_image_path"], master["cxr_text_path"],
            {"chexpert": master["cxr_chexpert"], "negbio": master["cxr_negbio"]}, config.findings,
        )
    )
    discharge = notes.discharge_notes(master["dsnotes"], links["discharge"])
    radiology = held(notes.radiology_notes(master["radnotes"], links["radiology"], stays))

    presence = cohort.modality_presence(stays, series, index, discharge, radiology)
    included = held(cohort.included_stays(stays, presence, config))
    flags = outcomes.outcomes(stays, config.los_range, config.readmission_range)
    own = [c for c in config.tabular_variables if c not in ("subject_id", "hadm_id", "stay_id")]
    shown = [*own, *[c for c in METADATA_VARIABLES if c not in own]]
    tabular = stays.select("subject_id", "hadm_id", "stay_id", *[quoted(c) for c in shown]).join(flags, "stay_id")
    tables = {
        "tabular": tabular.select("subject_id", "hadm_id", "stay_id", *[c for c in tabular.columns if c not in ("subject_id", "hadm_id", "stay_id")]),
        "time_series": series,
        "cxr_index": index,
        "notes_discharge": discharge,
        "notes_radiology": radiology,
    }
    return Training(stays, tables, presence, included, flags)


def included_tables(training: Training) -> dict[str, DataFrame]:
    """The five tables restricted to the included stays."""
    return {name: restrict(df, training.included, ["stay_id"]) for name, df in training.tables.items()}


def export_training(
    spark: SparkSession,
    master_folder: str,
    output: str,
    config: TrainingConfig | None = None,
    sort: bool = True,
    ascending: bool = True,
) -> DataFrame:
    """Read a master folder, write the five tables (event tables sorted), and audit what was written."""
    tune(spark)
    training = build_training(require(spark, master_folder, INPUTS), config)
    done = {
        name: written(df, f"{output}/{name}.parquet", True, OUTPUTS[name][1] if sort else [], ascending)
        for name, df in included_tables(training).items()
    }
    audited = {name: (df, OUTPUTS[name][0]) for name, df in done.items()}
    return cohort.fan_out_audit(audited, training.included.count())
