"""Sources, linkage and master export over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayloom.config import FINDINGS
from stayloom.driver.registry import query
from stayloom.driver.views import TABLES, Views
from stayloom.functions.times import coerce_datetimes, packed_datetime
from stayloom.functions.values import file_name, image_path, prefixed, with_extension
from stayloom.operators import images, joins, linkage
from stayloom.operators.linkage import STAY
from stayloom.sources.folders import scan_folder
from stayloom.session import settle
from stayloom.sources.sinks import sorted_by


def image_link(v: Views):
    return linkage.link_images(v.stays, v.timed_metadata)


def written_link(v: Views):
    """The image link, written once: metadata, paths and findings are filtered by its keys before they are shuffled."""
    return v.once("written_link", lambda: settle(image_link(v)))


def discharge_link(v: Views):
    return linkage.link_discharge_notes(v.stays, v["discharge"])


def radiology_link(v: Views):
    return linkage.link_radiology_notes(v.stays, v["radiology"])


def _written_note_link(v: Views, name: str, make, *columns: str):
    """A link of notes as a written table, made from written keys of the notes, by which stays are filtered."""
    keys = v.once(f"written_{name}_keys", lambda: settle(v[name].select(*linkage.ADMISSION, *columns)))
    return v.once(f"written_{name}_link", lambda: settle(make(v.stays, keys)))


def written_discharge_link(v: Views):
    return _written_note_link(v, "discharge", linkage.link_discharge_notes, "note_id")


def written_radiology_link(v: Views):
    return _written_note_link(v, "radiology", linkage.link_radiology_notes, "note_id", "charttime")


def links(v: Views):
    return linkage.link_table(v.stays, image_link(v), discharge_link(v), radiology_link(v))


@query(
    "scan_folder",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
)
def _(v: Views):
    """Every table of the folder as a view, with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in scan_folder(v.spark, v.folder).items()
    ]
    together = counts[0]
    for count in counts[1:]:
        together = together.unionByName(count)
    return together


@query(
    "coerce_datetime",
    """SELECT o_orderkey, o_orderstatus,
              TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'not known'
                            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS "OrderDate",
              TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP) AS booked_time
       FROM orders""",
)
def _(v: Views):
    texts = v["orders"].select(
        "o_orderkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("not known"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("OrderDate"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("booked_time"),
    )
    return coerce_datetimes(texts)


@query("packed_datetime", 'SELECT dicom_id, "StudyDatetime" FROM image_times', ["image_times"])
def _(v: Views):
    return v["cxr_metadata"].select("dicom_id", packed_datetime("StudyDate", "StudyTime").alias("StudyDatetime"))


@query("earliest_intime", "SELECT stay_id, intime, admittime, edregtime, earliest_intime FROM stays", ["stays"])
def _(v: Views):
    return v.stays.select("stay_id", "intime", "admittime", "edregtime", "earliest_intime")


@query("link_interval_join", "SELECT * FROM link_image", ["link_image"])
def _(v: Views):
    return image_link(v)


@query("link_discharge", "SELECT * FROM link_discharge", ["link_discharge"])
def _(v: Views):
    return discharge_link(v)


@query("link_radiology", "SELECT * FROM link_radiology", ["link_radiology"])
def _(v: Views):
    return radiology_link(v)


LINK_TABLE = """
    SELECT DISTINCT subject_id, hadm_id, stay_id, 'stay' AS link, CAST(NULL AS BIGINT) AS study_id,
           CAST(NULL AS VARCHAR) AS dicom_id, CAST(NULL AS VARCHAR) AS note_id FROM stays
    UNION ALL SELECT subject_id, hadm_id, stay_id, 'image', study_id, dicom_id, NULL FROM link_image
    UNION ALL SELECT subject_id, hadm_id, stay_id, 'discharge', NULL, NULL, note_id FROM link_discharge
    UNION ALL SELECT subject_id, hadm_id, stay_id, 'radiology', NULL, NULL, note_id FROM link_radiology"""


@query("link_table", LINK_TABLE, ["link_image", "link_discharge", "link_radiology"])
def _(v: Views):
    return links(v)


@query(
    "link_summary",
    """SELECT (SELECT count(DISTINCT subject_id) FROM stays) AS n_subjects,
              (SELECT count(DISTINCT hadm_id) FROM stays) AS n_admissions,
              (SELECT count(DISTINCT stay_id) FROM stays) AS n_stays,
              (SELECT count(DISTINCT study_id) FROM link_image) AS n_studies,
              (SELECT count(DISTINCT dicom_id) FROM link_image) AS n_images,
              (SELECT count(DISTINCT note_id) FROM link_discharge) AS n_discharge_notes,
              (SELECT count(DISTINCT note_id) FROM link_radiology) AS n_radiology_notes""",
    ["link_image", "link_discharge", "link_radiology"],
)
def _(v: Views):
    return linkage.link_summary(links(v))


@query(
    "key_tables",
    """SELECT 'stay' AS grain, subject_id, hadm_id, stay_id FROM stays
       UNION ALL SELECT DISTINCT 'hadm', subject_id, hadm_id, CAST(NULL AS BIGINT) FROM stays
       UNION ALL SELECT DISTINCT 'subject', subject_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM stays""",
    ["stays"],
)
def _(v: Views):
    keys = linkage.key_tables(linkage.link_table(v.stays, *(empty_link(v, n) for n in ("image", "note", "note"))))
    together = keys["stay"].withColumn("grain", F.lit("stay"))
    for name in ("hadm", "subject"):
        together = together.unionByName(keys[name].withColumn("grain", F.lit(name)), allowMissingColumns=True)
    return together


def empty_link(v: Views, kind: str):
    columns = "study_id bigint, dicom_id string" if kind == "image" else "note_id string"
    return v.spark.createDataFrame([], f"subject_id bigint, hadm_id bigint, stay_id bigint, {columns}")


@query(
    "debug_cohort",
    "SELECT subject_id, hadm_id, stay_id FROM stays ORDER BY subject_id, hadm_id, stay_id LIMIT 100",
    ["stays"],
)
def _(v: Views):
    """The first 100 stays: the reproducible subset of a trial run."""
    stays = linkage.link_table(v.stays, *(empty_link(v, n) for n in ("image", "note", "note")))
    return linkage.key_tables(stays, debug_limit=100)["stay"]


@query(
    "stay_chunk",
    """SELECT subject_id, hadm_id, stay_id FROM
           (SELECT *, row_number() OVER (ORDER BY stay_id) AS position FROM (SELECT DISTINCT subject_id, hadm_id, stay_id FROM stays))
       WHERE position > 500 AND position <= 1250""",
    ["stays"],
)
def _(v: Views):
    return linkage.chunk_of_stays(v.stays, 500, 1250)


# --- master export ------------------------------------------------------------------------------


@query(
    "cohort_semi_join",
    """SELECT * FROM chartevents
       WHERE (subject_id, hadm_id, stay_id) IN (SELECT subject_id, hadm_id, stay_id FROM link_radiology)""",
    ["chartevents", "link_radiology"],
)
def _(v: Views):
    return joins.restrict(v["chartevents"], radiology_link(v).select(*STAY).distinct(), STAY)


@query(
    "dictionary_join",
    """SELECT l_orderkey, l_linenumber, code, l_suppkey, l_shipdate, p_name AS label, p_brand AS category
       FROM (SELECT *, CASE WHEN l_suppkey % 5 = 0 THEN -l_partkey ELSE l_partkey END AS code FROM lineitem)
       LEFT JOIN part ON code = p_partkey""",
)
def _(v: Views):
    """Coded events with their dictionary entries; some codes have none."""
    code = F.when(F.col("l_suppkey") % 5 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    events = v["lineitem"].select("l_orderkey", "l_linenumber", code.alias("code"), "l_suppkey", "l_shipdate")
    dictionary = v["part"].select(
        "p_partkey", F.col("p_name").alias("label"), F.col("p_brand").alias("category")
    )
    return joins.look_up(events, dictionary, {"code": "p_partkey"}, ["label", "category"])


@query(
    "header_detail_join",
    """SELECT d.doc_id AS note_id, d.lang, d.text, c.turn, c.role, c.text AS detail_text
       FROM documents d LEFT JOIN conversations c ON d.doc_id = c.conv_id""",
)
def _(v: Views):
    header = v["documents"].select(F.col("doc_id").alias("note_id"), "lang", "text")
    detail = v["conversations"].select(F.col("conv_id").alias("note_id"), "turn", "role", "text")
    return joins.with_details(header, detail, ["note_id"])


@query(
    "linked_rows_distinct",
    """SELECT DISTINCT m.subject_id, m.study_id, m."ViewPosition" FROM cxr_metadata m
       JOIN link_image l ON m.subject_id = l.subject_id AND m.study_id = l.study_id""",
    ["cxr_metadata", "link_image"],
)
def _(v: Views):
    rows = v["cxr_metadata"].select("subject_id", "study_id", "ViewPosition")
    return joins.restrict(rows, image_link(v), ["subject_id", "study_id"]).distinct()


@query(
    "export_sorted",
    "SELECT stay_id, charttime, itemid, valuenum FROM chartevents ORDER BY stay_id, charttime",
    ["chartevents"],
)
def _(v: Views):
    return sorted_by(v["chartevents"].select("stay_id", "charttime", "itemid", "valuenum"), ["stay_id", "charttime"])


# --- images -------------------------------------------------------------------------------------

_LABELS = ", ".join(
    f'cxr_{name}."{f}" AS "{name}_{f}"' for name in ("chexpert", "negbio") for f in FINDINGS
)


def index(v: Views):
    return images.image_index(
        v.timed_metadata, written_link(v), v.windows, v["cxr_image_path"], v["cxr_text_path"],
        {"chexpert": v["cxr_chexpert"], "negbio": v["cxr_negbio"]},
    )


@query(
    "link_dedup",
    """SELECT l.stay_id, m.subject_id, m.study_id, m.dicom_id, m."ViewPosition"
       FROM cxr_metadata m JOIN link_image l
           ON m.subject_id = l.subject_id AND m.study_id = l.study_id AND m.dicom_id = l.dicom_id""",
    ["cxr_metadata", "link_image"],
)
def _(v: Views):
    rows = v["cxr_metadata"].select("subject_id", "study_id", "dicom_id", "ViewPosition")
    doubled = written_link(v).unionByName(written_link(v))
    return images.images_of_stays(rows, doubled)


IMAGE_INDEX = f"""
    SELECT stay_id, subject_id, study_id, dicom_id, "StudyDate", "StudyTime", "ViewPosition", "StudyDatetime",
           cxr_image_path.path AS image_path, cxr_text_path.path AS text_path, {_LABELS}
    FROM cxr_metadata JOIN image_times USING (subject_id, study_id, dicom_id)
    JOIN (SELECT stay_id, subject_id, study_id, dicom_id FROM link_image) USING (subject_id, study_id, dicom_id)
    JOIN (SELECT stay_id, start_time, end_time FROM windows) USING (stay_id)
    LEFT JOIN cxr_image_path USING (subject_id, study_id, dicom_id)
    LEFT JOIN cxr_text_path USING (subject_id, study_id)
    LEFT JOIN cxr_chexpert USING (subject_id, study_id)
    LEFT JOIN cxr_negbio USING (subject_id, study_id)
    WHERE "StudyDatetime" > start_time AND "StudyDatetime" < end_time"""
IMAGE_INDEX_VIEWS = [
    "cxr_metadata", "image_times", "link_image", "windows", "cxr_image_path", "cxr_text_path",
    "cxr_chexpert", "cxr_negbio",
]


@query("image_index", IMAGE_INDEX, IMAGE_INDEX_VIEWS)
def _(v: Views):
    return index(v)


@query(
    "label_prefix",
    "SELECT subject_id, study_id, "
    + ", ".join(f'"{f}" AS "chexpert_{f}"' for f in FINDINGS)
    + " FROM cxr_chexpert",
    ["cxr_chexpert"],
)
def _(v: Views):
    return prefixed(v["cxr_chexpert"], "chexpert_", FINDINGS)


@query(
    "view_filter",
    """SELECT subject_id, study_id, dicom_id FROM cxr_metadata WHERE "ViewPosition" IN ('AP', 'PA')""",
    ["cxr_metadata"],
)
def _(v: Views):
    return images.frontal(v["cxr_metadata"]).select("subject_id", "study_id", "dicom_id")


@query(
    "image_path",
    """SELECT dicom_id,
              'files/p' || substr(CAST(subject_id AS VARCHAR), 1, 2) || '/p' || subject_id || '/s' || study_id
                  || '/' || dicom_id || '.jpg' AS path,
              dicom_id || '.jpg' AS file
       FROM cxr_metadata""",
    ["cxr_metadata"],
)
def _(v: Views):
    dcm = image_path("subject_id", "study_id", "dicom_id", ".dcm")
    path = with_extension(dcm, ".jpg")
    return v["cxr_metadata"].select("dicom_id", path.alias("path"), file_name(path).alias("file"))


@query(
    "latest_image",
    """SELECT stay_id, subject_id, study_id, dicom_id, "StudyDatetime", "ViewPosition" FROM (
           SELECT l.stay_id, t.*, m."ViewPosition",
                  row_number() OVER (PARTITION BY l.stay_id ORDER BY t."StudyDatetime" DESC, t.dicom_id DESC) AS r
           FROM link_image l
           JOIN image_times t ON t.subject_id = l.subject_id AND t.study_id = l.study_id AND t.dicom_id = l.dicom_id
           JOIN cxr_metadata m ON t.subject_id = m.subject_id AND t.study_id = m.study_id AND t.dicom_id = m.dicom_id)
       WHERE r = 1""",
    ["link_image", "image_times", "cxr_metadata"],
)
def _(v: Views):
    rows = v.timed_metadata.select("subject_id", "study_id", "dicom_id", "StudyDatetime", "ViewPosition")
    return images.latest_image(images.images_of_stays(rows, written_link(v)))


@query(
    "image_count_stats",
    """SELECT count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
              CAST(min(n) AS DOUBLE) AS min, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50,
              quantile_cont(n, 0.75) AS p75, CAST(max(n) AS DOUBLE) AS max
       FROM (SELECT subject_id, CAST(count(*) AS DOUBLE) AS n FROM cxr_metadata
             WHERE "ViewPosition" IN ('AP', 'PA') GROUP BY subject_id)""",
    ["cxr_metadata"],
)
def _(v: Views):
    stats = images.image_count_stats(images.frontal(v["cxr_metadata"]), "subject_id")
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "vector_mean_pool",
    """SELECT stay_id, CAST(position AS INTEGER) AS position, round(avg(CAST(value AS DOUBLE)), 6) AS value FROM (
           SELECT stay_id, unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS position FROM vectors)
       GROUP BY stay_id, position""",
    ["vectors"],
)
def _(v: Views):
    pooled = images.mean_pool(v["vectors"])
    return pooled.select("stay_id", F.posexplode("embedding").alias("position", "value")).select(
        "stay_id", "position", F.round("value", 6).alias("value")
    )
