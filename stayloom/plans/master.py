"""Cohort linkage and the master dataset: every source table restricted to the linked stays."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.functions.times import coerce_datetimes
from stayloom.operators import linkage
from stayloom.operators.joins import look_up, restrict, with_details
from stayloom.operators.linkage import ADMISSION, IMAGE, STAY
from stayloom.session import tune
from stayloom.sources.folders import is_written, scan_folder
from stayloom.sources.ingest import ingest_folder
from stayloom.sources.sinks import write_table, written

GRAINS = {"subject": ["subject_id"], "hadm": ADMISSION, "stay": STAY}


@dataclass
class Export:
    """How one master table is made: source, key grain, and a dictionary or a detail table."""

    name: str
    grain: str
    dictionary: str | None = None
    on: Mapping[str, str] = field(default_factory=dict)
    columns: Sequence[str] | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    detail: str | None = None
    detail_on: Sequence[str] = ()


_ICD = {"icd_code": "icd_code", "icd_version": "icd_version"}
_ITEM = {"itemid": "itemid"}
_ITEM_COLUMNS = ["label", "category", "unitname"]

EXPORTS = [
    Export("patients", "subject"),
    Export("admissions", "hadm"),
    Export("transfers", "hadm"),
    Export("diagnoses_icd", "hadm", "d_icd_diagnoses", _ICD, ["long_title"]),
    Export("procedures_icd", "hadm", "d_icd_procedures", _ICD, ["long_title"]),
    Export("drgcodes", "hadm"),
    Export("services", "hadm"),
    Export("labevents", "hadm", "d_labitems", _ITEM, ["label", "fluid", "category"], {"label": "lab_label"}),
    Export("hcpcsevents", "hadm", "d_hcpcs", {"hcpcs_cd": "code"}),
    Export("microbiologyevents", "hadm"),
    Export("emar", "hadm", detail="emar_detail", detail_on=["emar_id"]),
    Export("poe", "hadm", detail="poe_detail", detail_on=["poe_id"]),
    Export("prescriptions", "hadm", detail="pharmacy", detail_on=["pharmacy_id"]),
    Export("icustays", "stay"),
    *[
        Export(name, "stay", "d_items", _ITEM, _ITEM_COLUMNS)
        for name in (
            "procedureevents", "outputevents", "inputevents", "datetimeevents", "chartevents", "ingredientevents",
        )
    ],
]

# master table: (end of the source name, keys)
IMAGE_EXPORTS = {
    "cxr_image_path": ("record-list", IMAGE),
    "cxr_text_path": ("study-list", IMAGE[:2]),
    "cxr_metadata": ("metadata", IMAGE),
    "cxr_chexpert": ("chexpert", IMAGE[:2]),
    "cxr_negbio": ("negbio", IMAGE[:2]),
    "cxr_split": ("split", IMAGE),
}


def source_ending(sources: Mapping[str, DataFrame], ending: str) -> DataFrame:
    """The one source table whose name ends so; releases differ in how the name begins."""
    names = [n for n in sources if n == ending or n.endswith(f"-{ending}")]
    if len(names) != 1:
        raise KeyError(f"expected one table named …-{ending}, found {names}")
    return sources[names[0]]


def register_sources(
    spark: SparkSession, hosp: str, icu: str, cxr: str, cxr_jpg: str, note: str, ingested: str | None = None
) -> dict[str, DataFrame]:
    """All tables of the five source folders; date columns are cast except in the image folders.

    With `ingested`, CSV tables are turned into typed parquet tables in that folder once and read from there.
    """
    sources: dict[str, DataFrame] = {}
    for folder, cast in ((hosp, True), (icu, True), (cxr, False), (cxr_jpg, False), (note, True)):
        if ingested is None:
            sources.update(scan_folder(spark, folder, cast))
        else:
            tables = ingest_folder(spark, folder, ingested)
            sources.update({n: coerce_datetimes(df) if cast else df for n, df in tables.items()})
    return sources


def link_cohort(sources: Mapping[str, DataFrame], image_times: DataFrame | None = None) -> DataFrame:
    """Long table of the images and notes linked to each stay."""
    if image_times is None:
        image_times = linkage.image_datetimes(source_ending(sources, "metadata"))
    stays = linkage.stays_with_admission(sources["icustays"], sources["admissions"])
    return linkage.link_table(
        stays,
        linkage.link_images(stays, image_times),
        linkage.link_discharge_notes(stays, sources["discharge"]),
        linkage.link_radiology_notes(stays, sources["radiology"]),
    )


def export_table(spec: Export, sources: Mapping[str, DataFrame], keys: Mapping[str, DataFrame]) -> DataFrame:
    """One hospital or ICU table restricted to the cohort and enriched."""
    df = restrict(sources[spec.name], keys[spec.grain], GRAINS[spec.grain])
    if spec.dictionary:
        dictionary = sources[spec.dictionary]
        columns = spec.columns or [c for c in dictionary.columns if c not in spec.on.values()]
        renamed = [spec.rename.get(c, c) for c in columns]
        dictionary = dictionary.select(
            *spec.on.values(), *[F.col(c).alias(n) for c, n in zip(columns, renamed)]
        )
        clash = {c: f"detail_{c}" for c in renamed if c in df.columns}
        df = look_up(
            df, dictionary.withColumnsRenamed(clash), dict(spec.on), [clash.get(c, c) for c in renamed]
        )
    if spec.detail:
        df = with_details(df, sources[spec.detail], spec.detail_on, drop=["subject_id"])
    return df


def image_export(
    name: str, sources: Mapping[str, DataFrame], image_link: DataFrame, image_times: DataFrame
) -> DataFrame:
    """Distinct rows of an image table that belong to a linked image or study."""
    ending, on = IMAGE_EXPORTS[name]
    rows = restrict(source_ending(sources, ending), image_link, on)
    if name == "cxr_metadata":
        rows = rows.join(image_times.select(*IMAGE, "StudyDatetime"), IMAGE, "left").select(
            *rows.columns, "StudyDatetime"
        )
    return rows.distinct()


def note_export(
    notes: DataFrame, link: DataFrame, detail: DataFrame | None = None
) -> DataFrame:
    """Distinct notes that are linked, with their detail rows if there are any."""
    linked = restrict(notes, link, [*ADMISSION, "note_id"]).distinct()
    if detail is None:
        return linked
    return with_details(linked, detail.distinct(), ["note_id"], drop=["subject_id"])


def master_tables(
    sources: Mapping[str, DataFrame],
    links: Mapping[str, DataFrame],
    keys: Mapping[str, DataFrame],
    image_times: DataFrame,
) -> Iterator[tuple[str, DataFrame]]:
    """Name and content of every master table."""
    scoped = {name: restrict(link, keys["stay"], STAY) for name, link in links.items()}
    for spec in EXPORTS:
        yield spec.name, export_table(spec, sources, keys)
    for name in IMAGE_EXPORTS:
        yield name, image_export(name, sources, scoped["image"], image_times)
    yield "dsnotes", note_export(sources["discharge"], scoped["discharge"])
    yield "radnotes", note_export(sources["radiology"], scoped["radiology"], sources.get("radiology_detail"))


def export_master(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    output: str,
    overwrite: bool = False,
    rebuild_links: bool = False,
    debug_limit: int | None = None,
    links_path: str | None = None,
    image_times_path: str | None = None,
    parallel_jobs: int = 4,
) -> dict[str, bool]:
    """Write the link table, the image times and every master table; finished ones are kept.

    The key tables are written too: all exports then see one cohort, and Spark knows their real
    size when it chooses how to join them.  Returns which tables were written now.
    """
    tune(spark)
    links_path = links_path or f"{output}/list_ids.parquet"
    image_times_path = image_times_path or f"{output}/cxr_study_datetime.parquet"

    if is_written(spark, image_times_path):
        image_times = spark.read.parquet(image_times_path)
    else:
        image_times = written(
            linkage.image_datetimes(source_ending(sources, "metadata")), image_times_path
        )
    if rebuild_links or not is_written(spark, links_path):
        write_table(link_cohort(sources, image_times), links_path, overwrite=True)
    links = spark.read.parquet(links_path)

    keys = {
        name: written(df, f"{output}/_keys/{name}", overwrite=True)
        for name, df in linkage.key_tables(links, debug_limit).items()
    }
    split = linkage.split_links(links)

    def write(item: tuple[str, DataFrame]) -> tuple[str, bool]:
        name, df = item
        return name, write_table(df, f"{output}/{name}.parquet", overwrite)

    # The exports are independent jobs; several at a time keep the cluster busy at their tails.
    with ThreadPoolExecutor(parallel_jobs) as pool:
        return dict(pool.map(write, master_tables(sources, split, keys, image_times)))
