"""Which images and notes belong to which stay.

The three links of a stay are independent of each other, so each is built and kept on its own;
their product per stay, which repeats every image for every pair of notes, is never formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.functions.times import earliest, packed_datetime
from stayloom.operators.joins import interval_join, known
from stayloom.operators.ordered import positions

STAY = ["subject_id", "hadm_id", "stay_id"]
ADMISSION = ["subject_id", "hadm_id"]
IMAGE = ["subject_id", "study_id", "dicom_id"]


def stays_with_admission(icustays: DataFrame, admissions: DataFrame) -> DataFrame:
    """Stays with their admission times and the earliest known arrival."""
    times = admissions.select(*ADMISSION, "admittime", "dischtime", "edregtime", "edouttime")
    return (
        icustays.select(*STAY, "intime", "outtime")
        .join(times, ADMISSION, "left")
        .withColumn("earliest_intime", earliest("intime", "admittime", "edregtime"))
    )


def image_datetimes(metadata: DataFrame) -> DataFrame:
    """When each image was taken."""
    return metadata.select(
        *IMAGE, packed_datetime("StudyDate", "StudyTime").alias("StudyDatetime")
    )


def link_images(stays: DataFrame, images: DataFrame) -> DataFrame:
    """Images of the same subject taken between earliest_intime and outtime, ends included."""
    spans = stays.select(*STAY, "earliest_intime", "outtime")
    points = images.select(*IMAGE, "StudyDatetime")
    pairs = interval_join(points, spans, ["subject_id"], "StudyDatetime", "earliest_intime", "outtime")
    return pairs.select(*STAY, "study_id", "dicom_id").distinct()


def link_discharge_notes(stays: DataFrame, notes: DataFrame) -> DataFrame:
    """Discharge notes of the admission, whatever their time."""
    keys = notes.select(*ADMISSION, "note_id").where(known("hadm_id"))
    return stays.select(*STAY).join(keys, ADMISSION).select(*STAY, "note_id").distinct()


def link_radiology_notes(stays: DataFrame, notes: DataFrame) -> DataFrame:
    """Radiology notes of the admission written between earliest_intime and outtime, ends included."""
    spans = stays.select(*STAY, "earliest_intime", "outtime")
    points = notes.select(*ADMISSION, "note_id", "charttime").where(known("hadm_id"))
    pairs = interval_join(points, spans, ADMISSION, "charttime", "earliest_intime", "outtime")
    return pairs.select(*STAY, "note_id").distinct()


def link_table(
    stays: DataFrame, image_link: DataFrame, discharge_link: DataFrame, radiology_link: DataFrame
) -> DataFrame:
    """All links in one long table; `link` says which. Every stay also has one 'stay' row."""
    none = F.lit(None)

    def rows(df: DataFrame, link: str, study=none, dicom=none, note=none) -> DataFrame:
        return df.select(
            *STAY,
            F.lit(link).alias("link"),
            study.cast("bigint").alias("study_id"),
            dicom.cast("string").alias("dicom_id"),
            note.cast("string").alias("note_id"),
        )

    return (
        rows(stays.select(*STAY).distinct(), "stay")
        .unionByName(rows(image_link, "image", F.col("study_id"), F.col("dicom_id")))
        .unionByName(rows(discharge_link, "discharge", note=F.col("note_id")))
        .unionByName(rows(radiology_link, "radiology", note=F.col("note_id")))
    )


def split_links(links: DataFrame) -> dict[str, DataFrame]:
    """The separate links of a long link table."""
    return {
        "stay": links.where("link = 'stay'").select(*STAY),
        "image": links.where("link = 'image'").select(*STAY, "study_id", "dicom_id"),
        "discharge": links.where("link = 'discharge'").select(*STAY, "note_id"),
        "radiology": links.where("link = 'radiology'").select(*STAY, "note_id"),
    }


def link_summary(links: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct subjects, admissions, stays, studies, images and notes, in one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    parts = split_links(links)
    wanted = [
        ("stay", {"n_subjects": "subject_id", "n_admissions": "hadm_id", "n_stays": "stay_id"}),
        ("image", {"n_studies": "study_id", "n_images": "dicom_id"}),
        ("discharge", {"n_discharge_notes": "note_id"}),
        ("radiology", {"n_radiology_notes": "note_id"}),
    ]
    rows = [parts[p].agg(*[count(c).alias(n) for n, c in counts.items()]) for p, counts in wanted]
    together = rows[0]
    for row in rows[1:]:
        together = together.unionByName(row, allowMissingColumns=True)
    names = [n for _, counts in wanted for n in counts]
    return together.agg(*[F.max(n).alias(n) for n in names])


def key_tables(links: DataFrame, debug_limit: int | None = None) -> dict[str, DataFrame]:
    """Distinct keys at stay, admission and subject grain, for the first stays only if asked."""
    stay = split_links(links)["stay"].distinct()
    if debug_limit is not None:
        stay = stay.orderBy(*STAY).limit(debug_limit)
    return {
        "stay": stay,
        "hadm": stay.select(*ADMISSION).distinct(),
        "subject": stay.select("subject_id").distinct(),
    }


def chunk_of_stays(stays: DataFrame, first: int, last: int) -> DataFrame:
    """Stays number `first` to `last - 1`, counted from 0 in stay order."""
    keys = stays.select(*STAY).distinct()
    numbered = positions(keys, "stay_id", ties=["hadm_id", "subject_id"])
    return numbered.where((F.col("position") > first) & (F.col("position") <= last)).drop("position")
