"""Fixed values of the clinical data model and the options of the training-set build."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------------------------

TABULAR_VARIABLES = [
    "subject_id", "hadm_id", "stay_id", "age", "gender", "race",
    "marital_status", "language", "insurance",
]

VITAL_SIGNS = [
    "Heart Rate",
    "Respiratory Rate",
    "O2 saturation pulseoxymetry",
    "Non Invasive Blood Pressure systolic",
    "Non Invasive Blood Pressure diastolic",
    "Non Invasive Blood Pressure mean",
    "Arterial Blood Pressure systolic",
    "Arterial Blood Pressure diastolic",
    "Arterial Blood Pressure mean",
    "GCS - Eye Opening",
    "GCS - Verbal Response",
    "GCS - Motor Response",
    "Temperature Fahrenheit",
]

FINDINGS = [
    "Atelectasis", "Cardiomegaly", "Consolidation", "Edema", "Enlarged Cardiomediastinum",
    "Fracture", "Lung Lesion", "Lung Opacity", "No Finding", "Pleural Effusion",
    "Pleural Other", "Pneumonia", "Pneumothorax", "Support Devices",
]

# column: (outlier_low, valid_low, valid_high, outlier_high)
VITAL_BOUNDS = {
    "Temperature Fahrenheit": (57.56, 78.8, 113.0, 116.6),
    "Heart Rate": (0.0, 0.0, 350.0, 390.0),
    "Respiratory Rate": (0.0, 0.0, 300.0, 330.0),
    "O2 saturation pulseoxymetry": (0.0, 0.0, 100.0, 150.0),
    "Non Invasive Blood Pressure systolic": (0.0, 0.0, 375.0, 375.0),
    "Non Invasive Blood Pressure diastolic": (0.0, 0.0, 375.0, 375.0),
    "Arterial Blood Pressure systolic": (0.0, 0.0, 375.0, 375.0),
    "Arterial Blood Pressure diastolic": (0.0, 0.0, 375.0, 375.0),
}

RACE_GROUPS = ["WHITE", "ASIAN", "HISPANIC", "BLACK"]  # first match wins
RACE_OTHER = "OTHER"
MISSING_MARITAL_STATUS = "UNKNOWN"

DATETIME_WORDS = ["time", "date", "dod"]
FRONTAL_VIEWS = ["AP", "PA"]
AGE_CUTOFFS = [65, 85]

METADATA_VARIABLES = [
    "admission_type", "admission_location", "discharge_location",
    "first_careunit", "last_careunit",
    "admittime", "dischtime", "edregtime", "edouttime", "intime", "outtime",
    "los", "hospital_expire_flag", "deathtime", "dod",
]

OUTCOME_QUESTIONS = {
    "hospital_expire_flag": "Will the patient die during current hospital admission?",
    "los_binary": "Will this patient's ICU stay exceed three days?",
}

MODALITY_MIXES = {
    "Baseline": ["tabular", "time_series"],
    "Baseline+Image": ["tabular", "time_series", "image"],
    "Baseline+Text": ["tabular", "time_series", "text"],
    "Baseline+Image+Text": ["tabular", "time_series", "image", "text"],
}

# --- options ----------------------------------------------------------------------------------


@dataclass
class TrainingConfig:
    """Options of the training-set build; hours are relative to ICU admission."""

    age_lower: int = 0
    age_upper: int = 150
    los_lower: float = 0
    drop_missing_ts: bool = False
    drop_missing_img: bool = False
    drop_missing_text: bool = False
    start_diff: int | None = None
    end_diff: int | None = None
    tabular_variables: list[str] = field(default_factory=lambda: list(TABULAR_VARIABLES))
    vital_signs: list[str] = field(default_factory=lambda: list(VITAL_SIGNS))
    findings: list[str] = field(default_factory=lambda: list(FINDINGS))
    los_range: float = 3
    readmission_range: int = 30
    debug_limit: int | None = None
