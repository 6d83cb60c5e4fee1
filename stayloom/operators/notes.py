"""Notes of a stay: detail fields, windowing and texts gathered per stay.

Texts and fields of a key are first a long table with their positions, which is a result of its own
and holds for keys of any size.  Gathering them into one value per key is a second step; one row
then has to hold the value.  `part_size` cuts such values into parts of so many members, numbered from 0;
without it there is one part.

Texts are told apart by their SHA-256.  They are ordered and numbered by keys alone; a text joins its
number at the end, once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.functions.values import quoted
from stayloom.operators.joins import known, restrict
from stayloom.operators.ordered import cut_points, positions
from stayloom.operators.windows import in_window

TEXTS_PER_SLICE = 20_000  # rows that carry long texts
DETAIL = ["field_name", "field_value", "field_ordinal"]
NOTE = ["subject_id", "hadm_id", "note_id"]


def gather_text(
    pieces: DataFrame,
    key: str,
    order: str,
    ties: Sequence[str],
    text: str | Column,
    separator: str,
    name: str,
    part_size: int | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """(key, part, name): the texts of a key joined in order; `text` may use `position`, 1, 2, …"""
    return join_pieces(positions(pieces, order, [key], ties, cuts=cuts), key, text, separator, name, part_size)


def join_pieces(
    numbered: DataFrame, key: str, text: str | Column, separator: str, name: str, part_size: int | None = None
) -> DataFrame:
    """(key, part, name): the numbered texts of a key joined in order."""
    text = F.col(text) if isinstance(text, str) else text
    return _in_parts(numbered, [key], text.alias("value"), part_size).select(
        key,
        F.col("_part").cast("int").alias("part"),
        F.array_join(F.transform("_members", lambda m: m["value"]), separator).alias(name),
    )


def _in_parts(numbered: DataFrame, by: Sequence[str], member: Column, part_size: int | None) -> DataFrame:
    part = F.floor((F.col("position") - 1) / part_size) if part_size else F.lit(0)
    return numbered.groupBy(*by, part.alias("_part")).agg(
        F.array_sort(F.collect_list(F.struct("position", member))).alias("_members")
    )


def with_version(notes: DataFrame) -> DataFrame:
    """Notes with a hash of all their columns that are not details; one that is there already stays.

    Hashed before details are attached, a note's text is not carried along with every detail.
    """
    if "_version" in notes.columns:
        return notes
    carried = [c for c in notes.columns if c not in DETAIL and c != "note_id"]
    shown = F.concat_ws("\x1f", *[F.coalesce(quoted(c).cast("string"), F.lit("\x1e")) for c in carried])
    return notes.withColumn("_version", F.unhex(F.sha2(shown, 256)))


def detail_rows(notes: DataFrame) -> DataFrame:
    """(note_id, _version, position and the detail columns): the fields of each note in order.

    Fields are ordered by ordinal, unnumbered ones last.  A field name may repeat in a note.
    """
    rows = with_version(notes).select("note_id", "_version", *DETAIL)
    return positions(
        rows, "field_ordinal", ["note_id", "_version"], ["field_name", "field_value"],
        cuts=cut_points(notes, "field_ordinal", TEXTS_PER_SLICE),
    )


def detail_lists(notes: DataFrame, part_size: int | None = None) -> DataFrame:
    """Collapse note × detail rows to one row per note with an ordered list of its fields.

    A note's own columns, its text among them, are no part of the rows that are ordered.
    """
    others = [c for c in notes.columns if c not in DETAIL and c != "_version"]
    field = F.struct(
        F.col("field_name").alias("name"),
        F.col("field_value").alias("value"),
        F.col("field_ordinal").alias("ordinal"),
    ).alias("field")
    by = ["note_id", "_version"]
    lists = _in_parts(detail_rows(notes), by, field, part_size)
    headers = with_version(notes.drop(*DETAIL)).groupBy(*by).agg(
        *[F.first(quoted(c)).alias(c) for c in others if c != "note_id"]
    )
    listed = lists.withColumnsRenamed({"note_id": "_note", "_version": "_of"})
    same = F.col("note_id").eqNullSafe(F.col("_note")) & (F.col("_version") == F.col("_of"))
    return headers.join(listed, same).select(
        *[quoted(c) for c in others],
        F.col("_part").cast("int").alias("detail_part"),
        F.transform("_members", lambda m: m["field"]).alias("detail_fields"),
    )


def notes_of_stays(notes: DataFrame, link: DataFrame) -> DataFrame:
    """Notes with the stays they are linked to; each (stay, note) pair counts once."""
    pairs = link.dropna(subset=["stay_id", "note_id"]).select("stay_id", *NOTE).distinct()
    return notes.join(pairs, NOTE).select("stay_id", *[quoted(c) for c in notes.columns])


def discharge_notes(notes: DataFrame, link: DataFrame) -> DataFrame:
    """Discharge notes of each stay; they are written at its end and never windowed."""
    return notes_of_stays(notes, link)


def radiology_notes(notes: DataFrame, link: DataFrame, windows: DataFrame) -> DataFrame:
    """Radiology notes inside the window of their stay, details collapsed."""
    if set(DETAIL) <= set(notes.columns):
        notes = detail_lists(notes)
    bounds = restrict(windows.select("stay_id", "start_time", "end_time"), link.where(known("note_id")), ["stay_id"])
    return in_window(
        notes_of_stays(notes, link), bounds, ["stay_id"], "charttime", ["stay_id", *notes.columns]
    )


def text_id(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.col(text), 256))


def first_appearances(notes: DataFrame, key: str = "stay_id", by: Sequence[str] = ()) -> DataFrame:
    """(key, by, text_id, charttime, note_id): where each text of a key stands first; `by` may hold charttime."""
    seen = F.min(F.struct("charttime", "note_id")).alias("_first")
    named = notes.select(key, "charttime", "note_id", text_id().alias("text_id"))
    return named.groupBy(key, *by, "text_id").agg(seen).select(
        key, "text_id", F.col("_first.charttime").alias("charttime"), F.col("_first.note_id").alias("note_id")
    )


def numbered_keys(notes: DataFrame, key: str = "stay_id", by: Sequence[str] = ()) -> DataFrame:
    """(key, text_id, charttime, note_id, position): the distinct texts of each key in order of appearance."""
    return positions(
        first_appearances(notes, key, by), "charttime", [key], ["note_id", "text_id"],
        cuts=cut_points(notes, "charttime", TEXTS_PER_SLICE),
    )


def with_texts(numbered: DataFrame, notes: DataFrame, key: str = "stay_id") -> DataFrame:
    """Rows of (key, text_id) with the text in place of its id.

    Rows and texts are one table of which texts are shuffled once, added up where they are.
    """
    row = F.struct(*[quoted(c) for c in numbered.columns if c not in (key, "text_id")])
    kind = numbered.select(row.alias("row")).schema["row"].dataType
    rows = numbered.select(key, "text_id", row.alias("_row"), F.lit(None).cast("string").alias("text"))
    texts = notes.select(key, text_id().alias("text_id"), F.lit(None).cast(kind).alias("_row"), "text")
    found = rows.unionByName(texts).groupBy(key, "text_id").agg(
        F.collect_list("_row").alias("_rows"), F.first("text", ignorenulls=True).alias("text")
    )
    return found.select(key, F.explode("_rows").alias("_row"), "text").select(key, "_row.*", "text")


def numbered_notes(notes: DataFrame, key: str = "stay_id", by: Sequence[str] = ()) -> DataFrame:
    """(key, position, charttime, note_id, text): the distinct texts of each key in order of appearance.

    With `by` = charttime a text counts once for each of its times.
    """
    return with_texts(numbered_keys(notes, key, by), notes, key).select(key, "position", "charttime", "note_id", "text")


def joined_texts(
    notes: DataFrame, key: str = "stay_id", separator: str = " [SEP] ", part_size: int | None = None
) -> DataFrame:
    """The distinct texts of each stay with a separator between them."""
    return join_pieces(numbered_notes(notes, key), key, "text", separator, "text", part_size)


def numbered_texts(notes: DataFrame, key: str = "stay_id", part_size: int | None = None) -> DataFrame:
    """The distinct texts of each stay as numbered reports, line breaks turned into spaces."""
    report = F.translate(
        F.concat(F.lit("Report "), F.col("position").cast("string"), F.lit(":\n"), F.col("text")), "\n", " "
    )
    return join_pieces(numbered_notes(notes, key), key, report, "", "text", part_size)
