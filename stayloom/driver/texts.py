"""Note lists, texts, profiles and prompts over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayloom.driver.linkage import written_link
from stayloom.driver.registry import query
from stayloom.driver.selection import RADIOLOGY, radiology
from stayloom.driver.views import VITALS, Views
from stayloom.operators import joins, notes, profiles
from stayloom.operators.images import images_of_stays
from stayloom.operators.linkage import IMAGE
from stayloom.session import settle

# --- detail lists and joined texts ----------------------------------------------------------------


@query(
    "detail_fields",
    """SELECT r.note_id, r.hadm_id, r.charttime, 0 AS detail_part, CAST(count(*) AS INTEGER) AS n_fields,
              string_agg(coalesce(field_name, '-') || '#' || coalesce(CAST(field_ordinal AS VARCHAR), '-') || '#'
                         || coalesce(field_value, '-'), '|'
                         ORDER BY field_ordinal NULLS LAST, field_name, field_value) AS fields
       FROM radiology r LEFT JOIN radiology_detail d ON r.note_id = d.note_id
       GROUP BY r.note_id, r.hadm_id, r.charttime""",
    ["radiology", "radiology_detail"],
)
def _(v: Views):
    # Written: texts are read and hashed once, details are attached to the hashes.
    header = settle(notes.with_version(v["radiology"]).drop("text"))
    rows = joins.with_details(header, v["radiology_detail"], ["note_id"], drop=["subject_id"])
    lists = notes.detail_lists(rows)
    dash = F.lit("-")
    shown = F.transform(
        "detail_fields",
        lambda f: F.concat_ws(
            "#", F.coalesce(f["name"], dash), F.coalesce(f["ordinal"].cast("string"), dash), F.coalesce(f["value"], dash)
        ),
    )
    return lists.select(
        "note_id", "hadm_id", "charttime", "detail_part", F.size("detail_fields").alias("n_fields"),
        F.array_join(shown, "|").alias("fields"),
    )


WHOLE = 10**12  # texts in a part: one part


def _joined(size: int, piece: str, separator: str) -> str:
    return f"""
        WITH seen AS (SELECT stay_id, text, min(charttime) AS charttime, arg_min(note_id, (charttime, note_id)) AS note_id
                      FROM stay_notes GROUP BY stay_id, text),
             numbered AS (SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY charttime, note_id) AS position FROM seen)
        SELECT stay_id, CAST((position - 1) // {size} AS INTEGER) AS part,
               string_agg({piece}, '{separator}' ORDER BY position) AS text
        FROM numbered GROUP BY stay_id, part"""


@query("notes_sep_join", _joined(WHOLE, "text", " [SEP] "), ["stay_notes"])
def _(v: Views):
    return notes.joined_texts(v["stay_notes"])


@query("notes_sep_join_parts", _joined(2, "text", " [SEP] "), ["stay_notes"])
def _(v: Views):
    """The same in parts of two texts."""
    return notes.joined_texts(v["stay_notes"], part_size=2)


@query(
    "notes_long",
    """SELECT stay_id, row_number() OVER (PARTITION BY stay_id ORDER BY charttime, note_id) AS position, charttime, note_id, text
       FROM (SELECT stay_id, text, min(charttime) AS charttime, arg_min(note_id, (charttime, note_id)) AS note_id
             FROM stay_notes GROUP BY stay_id, text)""",
    ["stay_notes"],
)
def _(v: Views):
    """The distinct texts of each stay as numbered rows, which holds for stays of any size."""
    return notes.numbered_notes(v["stay_notes"])


@query(
    "notes_numbered",
    _joined(WHOLE, r"replace('Report ' || position || ':' || chr(10) || text, chr(10), ' ')", ""),
    ["stay_notes"],
)
def _(v: Views):
    return notes.numbered_texts(v["stay_notes"])


# --- profile blocks -----------------------------------------------------------------------------

NL = "' || chr(10) || '"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''").replace("\n", NL) + "'"


def _shown(column: str) -> str:
    return f"coalesce(CAST({column} AS VARCHAR), 'nan')"


DEMOGRAPHIC = (
    "SELECT stay_id, "
    + _literal(profiles.DEMOGRAPHIC_HEAD)
    + " || "
    + " || ".join(f"{_literal(before)} || {_shown(c)}" for before, c in profiles.DEMOGRAPHIC_LINES)
    + f" || {_literal(profiles.DEMOGRAPHIC_TAIL)} AS demographics FROM base"
)


def _line(line) -> str:
    known = [c for _, c in line if c in VITALS]
    if not known:
        return "''"
    parts = [
        f"{_literal(before)} || " + (_shown(f'"{c}"') if c in VITALS else "'nan'") for before, c in line
    ]
    present = " OR ".join(f'"{c}" IS NOT NULL' for c in known)
    return f"CASE WHEN {present} THEN {' || '.join(parts)} || chr(10) ELSE '' END"


VITAL = f"""
    SELECT s.stay_id, 0 AS part, {_literal(profiles.VITAL_HEAD)} || string_agg(
        {_literal(profiles.VITAL_TIME[0])} || CAST(s.frac_charttime AS VARCHAR) || {_literal(profiles.VITAL_TIME[1])} || {" || ".join(_line(x) for x in profiles.VITAL_LINES)}, '' ORDER BY s.charttime) AS vital_signs
    FROM series s JOIN (SELECT stay_id, max(frac_charttime) AS last FROM series GROUP BY stay_id) m
        ON s.stay_id = m.stay_id
    WHERE s.frac_charttime >= m.last - 2 GROUP BY s.stay_id"""

REPORT = f"""
    SELECT r.stay_id, 0 AS part, {_literal(profiles.REPORT_HEAD)} || string_agg(
        {_literal(profiles.REPORT_TIME[0])} || CAST(round(date_diff('second', w.intime, r.charttime) / 3600.0, 2) AS VARCHAR)
        || {_literal(profiles.REPORT_TIME[1])} || {_literal(profiles.REPORT_TEXT[0])} || r.text || {_literal(profiles.REPORT_TEXT[1])},
        '' ORDER BY r.charttime, r.note_id) AS reports
    FROM (SELECT stay_id, charttime, text, min(note_id) AS note_id FROM ({RADIOLOGY}) GROUP BY stay_id, charttime, text) r
    JOIN windows w ON r.stay_id = w.stay_id GROUP BY r.stay_id"""
RADIOLOGY_VIEWS = ["radiology", "link_radiology", "windows"]

PROFILE = f"""
    SELECT d.stay_id, 0 AS part, concat_ws(chr(10), d.demographics, t.vital_signs,
               CASE WHEN i.stay_id IS NOT NULL THEN {_literal(profiles.IMAGE_BLOCK)} END, r.reports) AS context
    FROM ({DEMOGRAPHIC}) d
    LEFT JOIN ({VITAL}) t ON d.stay_id = t.stay_id
    LEFT JOIN (SELECT DISTINCT stay_id FROM link_image) i ON d.stay_id = i.stay_id
    LEFT JOIN ({REPORT}) r ON d.stay_id = r.stay_id"""
PROFILE_VIEWS = ["base", "series", "link_image", *RADIOLOGY_VIEWS]


def linked_images(v: Views):
    """Images of stays with their times, written once: profiles and records both read them."""
    taken = v.timed_metadata.select(*IMAGE, "StudyDatetime")
    return v.once("linked_images", lambda: settle(images_of_stays(taken, written_link(v))))


def write_read_parts(v: Views) -> None:
    """Write the stays and the windows' columns that profiles and records read, once."""
    v.write_stays()
    v.write_windows(
        "hadm_id", "stay_id", "start_time", "end_time", "intime", "age", "gender", "race", "marital_status",
        "language", "insurance", "hospital_expire_flag", "los",
    )


def tabular(v: Views):
    return v.windows.select(
        "stay_id", "intime", "age", "gender", "race", "marital_status", "language", "insurance"
    )


def gathered(v: Views):
    write_read_parts(v)
    return profiles.gathered_profiles(tabular(v), v.written_series, linked_images(v), settle(radiology(v)))


@query("profile_demographics", DEMOGRAPHIC, ["base"])
def _(v: Views):
    return profiles.demographic_block(tabular(v))


@query("profile_vitals", VITAL, ["series"])
def _(v: Views):
    return profiles.vital_block(v.written_series)


@query("profile_reports", REPORT, RADIOLOGY_VIEWS)
def _(v: Views):
    return profiles.report_block(settle(radiology(v)), tabular(v))


@query("patient_profile", PROFILE, PROFILE_VIEWS)
def _(v: Views):
    return profiles.with_context(gathered(v)).drop("last")


# --- records and prompts --------------------------------------------------------------------------

RECORDS = f"""
    SELECT row_number() OVER (ORDER BY p.stay_id) AS id, p.part, p.context,
           'files/p' || substr(CAST(i.subject_id AS VARCHAR), 1, 2) || '/p' || i.subject_id || '/s' || i.study_id
               || '/' || i.dicom_id || '.jpg' AS image,
           'Will the patient die during current hospital admission?' AS question_death,
           'Will this patient''s ICU stay exceed three days?' AS question_long,
           w.hospital_expire_flag AS answer_death, CASE WHEN w.los > 3 THEN 1 ELSE 0 END AS answer_long
    FROM ({PROFILE}) p JOIN windows w ON p.stay_id = w.stay_id
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY "StudyDatetime" DESC, dicom_id DESC) AS r
               FROM (SELECT l.stay_id, t.* FROM link_image l JOIN image_times t ON t.subject_id = l.subject_id
                         AND t.study_id = l.study_id AND t.dicom_id = l.dicom_id)) i
        ON p.stay_id = i.stay_id AND i.r = 1"""
RECORD_VIEWS = [*PROFILE_VIEWS, "image_times"]


def records(v: Views):
    profile = gathered(v)
    answers = v.windows.select(
        "stay_id", "hospital_expire_flag", (F.col("los") > 3).cast("int").alias("los_binary")
    )
    return profiles.qa_records(profile, linked_images(v), answers)


@query("qa_records", RECORDS, RECORD_VIEWS)
def _(v: Views):
    return records(v).select(
        "id", "part", "context", "image",
        F.col("question")["hospital_expire_flag"].alias("question_death"),
        F.col("question")["los_binary"].alias("question_long"),
        F.col("answer")["hospital_expire_flag"].alias("answer_death"),
        F.col("answer")["los_binary"].alias("answer_long"),
    )


def _prompt(style: str, system: str) -> str:
    between, closing = profiles.PROMPT_STYLES[style]
    return f"""
        SELECT id, part, {_literal(system)} AS system,
               {_literal(profiles.PROMPT_HEAD)} || context || {_literal(between)} || question_long || {_literal(closing)} AS prompt,
               list_extract(string_split(image, '/'), -1) AS image_file
        FROM ({RECORDS})"""


@query("prompt_text", _prompt("plain", profiles.SYSTEM_TEXTS["physician"]), RECORD_VIEWS)
def _(v: Views):
    return profiles.prompts(records(v), "los_binary", "plain", "physician")


@query("prompt_text_confident", _prompt("confident", profiles.SYSTEM_TEXTS["images"]), RECORD_VIEWS)
def _(v: Views):
    return profiles.prompts(records(v), "los_binary", "confident", "images")
