"""Note lists, texts and image operators on literal rows."""

import pytest
from conftest import at, rows

from stayloom.operators import images, joins, notes

NOTE = "stay_id long, note_id string, charttime timestamp_ntz, text string"


def test_detail_lists(frame):
    df = frame(
        "note_id string, subject_id long, hadm_id long, text string, field_name string, field_value string, field_ordinal int",
        [
            ("a", 1, 10, "t", "exam", "second", 2), ("a", 1, 10, "t", "exam", "first", 1),
            ("a", 1, 10, "t", "code", "unnumbered", None), ("b", 1, 10, "u", None, None, None),
        ],
    )
    got = notes.detail_lists(df)
    assert got.columns == ["note_id", "subject_id", "hadm_id", "text", "detail_part", "detail_fields"]
    found = {r["note_id"]: [tuple(f) for f in r["detail_fields"]] for r in got.collect()}
    assert found == {
        "a": [("exam", "first", 1), ("exam", "second", 2), ("code", "unnumbered", None)],
        "b": [(None, None, None)],
    }


def test_a_note_with_many_fields_comes_in_parts(frame):
    data = [("a", "t", "f", str(i), i) for i in range(25)]
    df = frame("note_id string, text string, field_name string, field_value string, field_ordinal int", data)
    parts = notes.detail_lists(df, part_size=10).orderBy("detail_part").collect()
    assert [(r["detail_part"], len(r["detail_fields"])) for r in parts] == [(0, 10), (1, 10), (2, 5)]
    assert [f["ordinal"] for r in parts for f in r["detail_fields"]] == list(range(25))


def test_details_are_attached_to_hashes_of_the_notes(frame):
    """Versions made before details are attached give the same lists; the text is then not in the rows."""
    header = frame("note_id string, hadm_id long, text string", [("a", 1, "t"), ("a", 1, "u"), ("b", 2, None)])
    detail = frame("note_id string, field_name string, field_value string, field_ordinal int", [("a", "exam", "x", 1)])
    whole = notes.detail_lists(joins.with_details(header, detail, ["note_id"]))
    bare = notes.with_version(header).drop("text")
    got = notes.detail_lists(joins.with_details(bare, detail, ["note_id"]))
    assert got.columns == ["note_id", "hadm_id", "detail_part", "detail_fields"]
    assert rows(got, *got.columns) == rows(whole.drop("text"), *got.columns)
    assert got.count() == 3


def test_texts_join_their_rows_without_a_join(frame):
    df = frame(NOTE, [(1, "n1", at("2150-01-01"), "x"), (1, "n2", at("2150-01-02"), "x"), (None, "n3", at("2150-01-01"), None)])
    numbered = notes.numbered_keys(df, by=["charttime"])
    got = notes.with_texts(numbered.localCheckpoint(), df)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r["stay_id"], r["position"], r["note_id"], r["text"]) for r in got.collect()), key=str) == [
        (1, 1, "n1", "x"), (1, 2, "n2", "x"), (None, 1, "n3", None)
    ]


def test_radiology_notes_of_a_stay_listed_twice(frame):
    """Each link counts once; a stay listed twice brings its notes twice."""
    df = frame(
        "subject_id long, hadm_id long, note_id string, charttime timestamp_ntz, text string",
        [(1, 10, "a", at("2150-01-02"), "in"), (1, 10, "b", at("2150-01-05"), "out"), (1, 10, None, at("2150-01-02"), "no id")],
    )
    link = frame("subject_id long, hadm_id long, stay_id long, note_id string", [(1, 10, 5, "a"), (1, 10, 5, "a"), (1, 10, 5, "b")])
    stays = frame("stay_id long, start_time timestamp_ntz, end_time timestamp_ntz", [(5, at("2150-01-01"), at("2150-01-03"))] * 2)
    got = notes.radiology_notes(df, link, stays)
    assert got.columns == ["stay_id", *df.columns]
    assert rows(got, "stay_id", "note_id", "text") == [(5, "a", "in")] * 2


@pytest.fixture
def reports(frame):
    return frame(
        NOTE,
        [
            (1, "n3", at("2150-01-03"), "third"), (1, "n1", at("2150-01-01"), "first"),
            (1, "n2", at("2150-01-02"), "first"), (1, "n4", at("2150-01-03"), "line\nbreak"), (2, "n5", at("2150-01-01"), "x"),
        ],
    )


def test_joined_texts(reports):
    assert rows(notes.joined_texts(reports), "stay_id", "part", "text") == [
        (1, 0, "first [SEP] third [SEP] line\nbreak"), (2, 0, "x")
    ]


def test_numbered_texts(reports):
    assert rows(notes.numbered_texts(reports), "stay_id", "text") == [
        (1, "Report 1: firstReport 2: thirdReport 3: line break"), (2, "Report 1: x")
    ]


def test_parts_join_to_the_whole_text(frame):
    data = [(1, f"n{i:03d}", at("2150-01-01"), f"text {i}") for i in range(40)]
    whole = notes.joined_texts(frame(NOTE, data)).first()["text"]
    parts = notes.joined_texts(frame(NOTE, data), part_size=7).orderBy("part").collect()
    assert len(parts) == 6
    assert " [SEP] ".join(r["text"] for r in parts) == whole


def test_notes_of_stays_count_once(frame):
    source = frame("note_id string, subject_id long, hadm_id long, charttime timestamp_ntz, text string",
                   [("a", 1, 10, at("2150-01-02"), "t")])
    link = frame("subject_id long, hadm_id long, stay_id long, note_id string",
                 [(1, 10, 100, "a"), (1, 10, 100, "a"), (1, 10, 101, "a"), (1, 10, 102, None)])
    assert rows(notes.discharge_notes(source, link), "stay_id", "note_id") == [(100, "a"), (101, "a")]


def test_latest_image_and_views(frame):
    df = frame(
        "stay_id long, dicom_id string, StudyDatetime timestamp_ntz, ViewPosition string",
        [(1, "a", at("2150-01-01"), "AP"), (1, "b", at("2150-01-02"), "LL"), (1, "c", at("2150-01-02"), None)],
    )
    assert rows(images.latest_image(df), "stay_id", "dicom_id") == [(1, "c")]
    assert rows(images.frontal(df), "dicom_id") == [("a",)]


def test_image_count_stats(frame):
    df = frame("stay_id long", [(1,)] * 1 + [(2,)] * 2 + [(3,)] * 6)
    got = images.image_count_stats(df).first()
    assert (got["count"], got["mean"], got["min"], got["p25"], got["p50"], got["p75"], got["max"]) == (
        3, 3.0, 1.0, 1.5, 2.0, 4.0, 6.0
    )
    assert got["std"] == pytest.approx(7 ** 0.5)


def test_mean_pool(frame):
    df = frame("stay_id long, embedding array<float>", [(1, [1.0, 2.0]), (1, [3.0, 6.0]), (2, [5.0, 5.0]), (2, None)])
    assert rows(images.mean_pool(df)) == [(1, [2.0, 4.0]), (2, [5.0, 5.0])]


def test_image_index_prefixes_labelers(frame):
    keys = "subject_id long, study_id long, dicom_id string"
    metadata = frame(f"{keys}, StudyDatetime timestamp_ntz", [(1, 5, "d", at("2150-01-02")), (1, 5, "e", at("2150-01-03"))])
    link = frame(f"stay_id long, {keys}", [(100, 1, 5, "d"), (100, 1, 5, "d"), (100, 1, 5, "e")])
    windows = frame("stay_id long, start_time timestamp_ntz, end_time timestamp_ntz", [(100, at("2150-01-01"), at("2150-01-03"))])
    labels = frame("subject_id long, study_id long, `Lung Lesion` double", [(1, 5, 1.0)])
    got = images.image_index(
        metadata, link, windows,
        frame(f"{keys}, path string", [(1, 5, "d", "p.dcm")]),
        frame("subject_id long, study_id long, path string", []),
        {"chexpert": labels, "negbio": labels.where("false")}, ["Lung Lesion"],
    )
    assert got.columns[4:] == ["StudyDatetime", "image_path", "text_path", "chexpert_Lung Lesion", "negbio_Lung Lesion"]
    assert rows(got.drop("StudyDatetime")) == [(100, 1, 5, "d", "p.dcm", None, 1.0, None)]


def test_more_than_two_thousand_texts_and_fields_stay_whole(frame):
    texts = frame(NOTE, [(1, f"n{i:05d}", at("2150-01-01"), f"text {i}") for i in range(2_500)])
    got = notes.joined_texts(texts).collect()
    assert [(r["part"], r["text"].count("[SEP]")) for r in got] == [(0, 2_499)]
    fields = frame("note_id string, text string, field_name string, field_value string, field_ordinal int",
                   [("a", "t", "f", str(i), i) for i in range(2_500)] + [("a", "u", "g", "x", 1), (None, None, "h", None, 2)])
    assert sorted((r["text"] or "", len(r["detail_fields"])) for r in notes.detail_lists(fields).collect()) == [("", 1), ("t", 2_500), ("u", 1)]


def test_a_text_counts_once_for_each_time_if_asked(frame):
    df = frame(NOTE, [(1, "b", at("2150-01-02"), "x"), (1, "a", at("2150-01-01"), "x"), (1, "c", at("2150-01-02"), "x"), (None, "d", at("2150-01-03"), "y")])
    assert rows(notes.numbered_notes(df), "stay_id", "position", "note_id") == [(1, 1, "a"), (None, 1, "d")]
    assert rows(notes.numbered_notes(df, by=["charttime"]), "stay_id", "position", "note_id") == [(1, 1, "a"), (1, 2, "b"), (None, 1, "d")]


def test_no_text_in_a_shuffle_key(frame):
    """Neither grouping nor joining nor ordering deals rows by their text."""
    import re

    df = frame(NOTE, [(i % 5, f"n{i}", at("2150-01-01"), f"text {i}") for i in range(40)])
    plan = notes.joined_texts(df)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange (?:hash|range)partitioning\(([^)]*)", plan)
    assert dealt and not any(re.search(r"\btext#", keys) for keys in dealt)
