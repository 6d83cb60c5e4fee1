"""Stays as text: profiles, question records and prompts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.config import OUTCOME_QUESTIONS
from stayloom.functions.times import hours_between
from stayloom.functions.values import file_name, image_path, number_text, quoted
from stayloom.operators.images import latest_image
from stayloom.operators.notes import TEXTS_PER_SLICE, gather_text, join_pieces, numbered_keys, with_texts
from stayloom.operators.ordered import cut_points, positions
from stayloom.operators.timeseries import last_hours
from stayloom.session import settle

# --- fixed values: the texts around the data -------------------------------------------------------

DEMOGRAPHIC_LINES = [
    ("\n        - Age: ", "age"),
    ("\n        - Gender: ", "gender"),
    ("\n        - Race: ", "race"),
    ("\n        - Marital Status: ", "marital_status"),
    ("\n        - Language: ", "language"),
    ("\n        - Insurance: ", "insurance"),
]
DEMOGRAPHIC_HEAD, DEMOGRAPHIC_TAIL = "Patient Demographics:", "\n        "

VITAL_HEAD = "Vital Signs:\n"
VITAL_TIME = ("- Time from ICU Admission: ", " hours\n")
# A line appears when one of its variables is present; the texts go before each variable.
VITAL_LINES = [
    [("    - Heart Rate: ", "Heart Rate")],
    [("    - Respiratory Rate: ", "Respiratory Rate")],
    [("    - Peripheral Oxygen Saturation: ", "O2 saturation pulseoxymetry")],
    [
        ("    - Non-invasive Blood Pressure (Systolic/Diastolic/Mean): ", "Non Invasive Blood Pressure systolic"),
        (" / ", "Non Invasive Blood Pressure diastolic"),
        (" / ", "Non Invasive Blood Pressure mean"),
    ],
    [
        ("    - Arterial Blood Pressure (Systolic/Diastolic/Mean): ", "Arterial Blood Pressure systolic"),
        (" / ", "Arterial Blood Pressure diastolic"),
        (" / ", "Arterial Blood Pressure mean"),
    ],
    [
        ("    - GCS: Eye Opening: ", "GCS - Eye Opening"),
        (", Verbal Response: ", "GCS - Verbal Response"),
        (", Motor Response: ", "GCS - Motor Response"),
    ],
    [("    - Temperature Fahrenheit: ", "Temperature Fahrenheit")],
]

IMAGE_BLOCK = "Chest X-Ray Images:\n- The uploaded image is the most recent chest X-ray image.\n"

REPORT_HEAD = "Radiology Reports:\n"
REPORT_TIME = ("- Time from ICU Admission: ", " hours\n")
REPORT_TEXT = ("    - Report Text: ", "\n")

MISSING = "nan"

PROMPT_HEAD = "Based on the information collected during current ICU stay, \n"
# style: (between context and question, after the question)
PROMPT_STYLES = {
    "plain": ("\n", "\nAnswer the question using only yes or no."),
    "confident": (
        "\n<image>",
        "\nProvide a confident and definitive answer."
        "Answer the question using only yes or no without any additional explanation",
    ),
}
SYSTEM_TEXTS = {
    "physician": "You are a helpful critical care physician.",
    "images": (
        "You are a critical care physician analyzing ICU patient data and chest X-rays. "
        "Provide precise only yes/no answers based on the given information."
    ),
}

# ----------------------------------------------------------------------------------------------------

_BLOCKS = 4  # demographics, vital signs, images, reports

RECORD_SCHEMA = (
    "id bigint, part int, last boolean, context string, image string, "
    "question map<string,string>, answer map<string,int>"
)


def _demographic_text(values: Callable[[str], Column]) -> Column:
    pieces: list[Column] = [F.lit(DEMOGRAPHIC_HEAD)]
    for before, column in DEMOGRAPHIC_LINES:
        pieces += [F.lit(before), F.coalesce(values(column).cast("string"), F.lit(MISSING))]
    return F.concat(*pieces, F.lit(DEMOGRAPHIC_TAIL))


def demographic_block(tabular: DataFrame, key: str = "stay_id") -> DataFrame:
    """(key, demographics): age, gender, race and so on, one line each."""
    return tabular.select(key, _demographic_text(quoted).alias("demographics"))


def _vital_row(columns: list[str]) -> Column:
    """Text of one row of the series; lines without any value are left out."""
    pieces: list[Column] = [F.lit(VITAL_TIME[0]), number_text("frac_charttime"), F.lit(VITAL_TIME[1])]
    for line in VITAL_LINES:
        known = [v for _, v in line if v in columns]
        if not known:
            continue
        parts: list[Column] = []
        for before, variable in line:
            value = number_text(variable) if variable in columns else F.lit(None).cast("string")
            parts += [F.lit(before), F.coalesce(value, F.lit(MISSING))]
        present = F.coalesce(*[quoted(v) for v in known]).isNotNull()
        pieces.append(F.when(present, F.concat(*parts, F.lit("\n"))).otherwise(F.lit("")))
    return F.concat(*pieces)


def vital_block(series: DataFrame, hours: float = 2, key: str = "stay_id", part_size: int | None = None) -> DataFrame:
    """(key, part, vital_signs): the rows of the last `hours` hours of each stay."""
    rows = last_hours(series, hours, key).select(
        key, "charttime", _vital_row(series.columns).alias("line")
    )
    block = gather_text(
        rows, key, "charttime", [], "line", "", "vital_signs", part_size, cut_points(series, "charttime", TEXTS_PER_SLICE)
    )
    head = F.when(F.col("part") == 0, F.lit(VITAL_HEAD)).otherwise(F.lit(""))
    return block.withColumn("vital_signs", F.concat(head, F.col("vital_signs")))


def image_block(images: DataFrame, key: str = "stay_id") -> DataFrame:
    """(key, images): a fixed text for every stay with an image."""
    return images.select(key).distinct().withColumn("images", F.lit(IMAGE_BLOCK))


def report_block(notes: DataFrame, stays: DataFrame, key: str = "stay_id", part_size: int | None = None) -> DataFrame:
    """(key, part, reports): each (time, text) of a stay once, with its hours since ICU admission."""
    admitted = stays.select(key, "intime")
    elapsed = F.round(hours_between("intime", "charttime"), 2)
    line = F.concat(
        F.lit(REPORT_TIME[0]), number_text(elapsed), F.lit(REPORT_TIME[1]),
        F.lit(REPORT_TEXT[0]), F.col("text"), F.lit(REPORT_TEXT[1]),
    )
    numbered = numbered_keys(notes, key, ["charttime"]).join(admitted, key)  # before the texts, which are long
    lines = with_texts(numbered, notes, key)
    block = join_pieces(lines, key, line, "", "reports", part_size)
    head = F.when(F.col("part") == 0, F.lit(REPORT_HEAD)).otherwise(F.lit(""))
    return block.withColumn("reports", F.concat(head, F.col("reports")))


def gathered_profiles(
    tabular: DataFrame, series: DataFrame, images: DataFrame, radiology: DataFrame, key: str = "stay_id",
    part_size: int | None = None,
) -> DataFrame:
    """(key, part, last, blocks): the blocks a stay has, not yet written out.

    Every stay has demographics, whose text is several times as long as their values, so the values go
    through joins and grouping and `with_context` writes the text in the end.
    """
    values = F.struct(*[quoted(c) for _, c in DEMOGRAPHIC_LINES])
    kind = tabular.select(values.alias("values")).schema["values"].dataType

    def block(df: DataFrame, number: int, text: str | None) -> DataFrame:
        piece = F.col("part") if "part" in df.columns else F.lit(0)
        return df.select(
            key, F.lit(number).alias("block"), piece.alias("piece"),
            (F.lit(None).cast("string") if text is None else F.col(text)).alias("text"),
            (values if text is None else F.lit(None).cast(kind)).alias("values"),
        )

    blocks = (
        block(tabular, 0, None)
        .unionByName(block(vital_block(series, 2, key, part_size), 1, "vital_signs"))
        .unionByName(block(image_block(images, key), 2, "images"))
        .unionByName(block(report_block(radiology, tabular, key, part_size), 3, "reports"))
        .where(F.col(key).isNotNull())
    )
    members = F.collect_list(F.struct("block", "piece", "text", "values")).alias("blocks")
    if part_size is None:  # every block is one piece
        return blocks.groupBy(key).agg(members).select(
            key, F.lit(0).alias("part"), F.lit(True).alias("last"), "blocks"
        )
    blocks = settle(blocks)
    # A part begins with each further piece of a block: parts count the pieces beyond each block's first.
    further = [F.max(F.when(F.col("block") == b, F.col("piece"))).alias(f"_of_{b}") for b in range(_BLOCKS)]
    more = blocks.groupBy(key).agg(*further)
    known = [F.coalesce(f"_of_{b}", F.lit(0)) for b in range(_BLOCKS)]
    before = sum((F.when(F.col("block") > b, known[b]).otherwise(F.lit(0)) for b in range(_BLOCKS)), F.lit(0))
    joined = (
        blocks.join(more, key)
        .groupBy(key, (before + F.col("piece")).cast("int").alias("part"))
        .agg(members, F.max(sum(known, F.lit(0))).alias("_end"))
    )
    return joined.select(key, "part", (F.col("part") == F.col("_end")).alias("last"), "blocks")


def _context(blocks: str = "blocks") -> Column:
    """The text of gathered blocks, which are joined by a line break, the pieces of one block by nothing."""

    def written(b: Column) -> Column:
        opens = (b["piece"] == 0) & (b["block"] > 0)
        text = F.when(b["block"] == 0, _demographic_text(lambda c: b["values"][c])).otherwise(b["text"])
        return F.struct(
            b["block"].alias("block"), b["piece"].alias("piece"),
            F.concat(F.when(opens, F.lit("\n")).otherwise(F.lit("")), text).alias("text"),
        )

    return F.array_join(F.transform(F.array_sort(F.transform(blocks, written)), lambda r: r["text"]), "")


def with_context(gathered: DataFrame) -> DataFrame:
    """Gathered profiles with their text in place of the blocks."""
    others = [quoted(c) for c in gathered.columns if c != "blocks"]
    return gathered.select(*others, _context().alias("context"))


def patient_profiles(
    tabular: DataFrame, series: DataFrame, images: DataFrame, radiology: DataFrame, key: str = "stay_id",
    part_size: int | None = None,
) -> DataFrame:
    """(key, part, last, context): the blocks a stay has, one after the other.

    Without `part_size` every stay has part 0 only.  With it a new part begins with each piece beyond a
    block's first; joined in `part` order without separator they give the profile, `last` marks the end.
    """
    return with_context(gathered_profiles(tabular, series, images, radiology, key, part_size))


def qa_records(
    profiles: DataFrame,
    images: DataFrame,
    answers: DataFrame,
    key: str = "stay_id",
    questions: Mapping[str, str] = OUTCOME_QUESTIONS,
) -> DataFrame:
    """Numbered records of profile, last image, questions and answers, in stay order.

    Profiles that are gathered only get their text after the joins, which then carry no texts.
    """
    paths = latest_image(images, key).select(
        key, image_path("subject_id", "study_id", "dicom_id").alias("image")
    )
    question = F.create_map(*[F.lit(t) for pair in questions.items() for t in pair])
    answer = F.create_map(
        *[x for name in questions for x in (F.lit(name), quoted(name).cast("int"))]
    )
    context = _context() if "blocks" in profiles.columns else F.col("context")
    keyed = positions(answers.select(key, *questions), key, name="id")
    return (
        keyed.join(profiles, key)
        .join(paths, key, "left")
        .select("id", "part", "last", context.alias("context"), "image", question.alias("question"), answer.alias("answer"))
    )


def prompts(records: DataFrame, outcome: str, style: str = "plain", system: str | None = None) -> DataFrame:
    """(id, part, system, prompt, image_file): the text put to a model about one outcome.

    The opening goes on the first part of a record and the question on its last one.  `system` is the name
    of one of SYSTEM_TEXTS or a text of one's own.
    """
    between, closing = PROMPT_STYLES[style]
    opening = F.when(F.col("part") == 0, F.lit(PROMPT_HEAD)).otherwise(F.lit(""))
    ending = F.when(
        F.col("last"), F.concat(F.lit(between), F.col("question")[outcome], F.lit(closing))
    ).otherwise(F.lit(""))
    return records.select(
        "id",
        "part",
        F.lit(SYSTEM_TEXTS.get(system, system) if system else None).cast("string").alias("system"),
        F.concat(opening, F.col("context"), ending).alias("prompt"),
        file_name("image").alias("image_file"),
    )
