"""Links, joins and key tables on literal rows."""

import random
from datetime import timedelta

import pytest
from conftest import at, rows

from stayloom.operators import joins, linkage


@pytest.fixture
def stays(frame):
    icu = frame(
        "subject_id long, hadm_id long, stay_id long, intime timestamp_ntz, outtime timestamp_ntz",
        [
            (1, 10, 100, at("2150-01-02"), at("2150-01-05")),
            (1, 10, 101, at("2150-01-04"), at("2150-01-08")),
            (2, 20, 200, at("2150-03-01"), at("2150-03-02")),
            (3, 30, 300, at("2150-03-01"), at("2150-03-02")),
        ],
    )
    adm = frame(
        "subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, "
        "edregtime timestamp_ntz, edouttime timestamp_ntz",
        [
            (1, 10, at("2150-01-01 12:00:00"), at("2150-01-09"), at("2150-01-01 08:00:00"), None),
            (2, 20, at("2150-03-01 06:00:00"), at("2150-03-03"), None, None),
        ],
    )
    return linkage.stays_with_admission(icu, adm)


def test_earliest_intime(stays):
    assert dict(rows(stays, "stay_id", "earliest_intime")) == {
        100: at("2150-01-01 08:00:00"), 101: at("2150-01-01 08:00:00"),
        200: at("2150-03-01"), 300: at("2150-03-01"),
    }


def test_image_window_is_closed(frame, stays):
    images = frame(
        "subject_id long, study_id long, dicom_id string, StudyDatetime timestamp_ntz",
        [
            (1, 1, "at start", at("2150-01-01 08:00:00")),
            (1, 1, "before", at("2150-01-01 07:59:59")),
            (1, 2, "at first end", at("2150-01-05")),
            (1, 3, "after first", at("2150-01-05 00:00:01")),
            (1, 3, "after first", at("2150-01-05 00:00:01")),
            (2, 4, "other subject", at("2150-01-03")),
            (1, 5, "no time", None),
        ],
    )
    got = linkage.link_images(stays, images)
    assert rows(got, "stay_id", "dicom_id") == [
        (100, "at first end"), (100, "at start"),
        (101, "after first"), (101, "at first end"), (101, "at start"),
    ]


def test_note_links(frame, stays):
    notes = frame(
        "note_id string, subject_id long, hadm_id long, charttime timestamp_ntz",
        [("late", 1, 10, at("2150-02-01")), ("in", 1, 10, at("2150-01-08")), ("none", 2, None, at("2150-03-01"))],
    )
    assert rows(linkage.link_discharge_notes(stays, notes), "stay_id", "note_id") == [
        (100, "in"), (100, "late"), (101, "in"), (101, "late")
    ]
    assert rows(linkage.link_radiology_notes(stays, notes), "stay_id", "note_id") == [(101, "in")]


def test_interval_join_equals_brute_force(frame):
    rng = random.Random(4)
    start = at("2150-01-01")

    def moment():
        return start + timedelta(hours=rng.randrange(2000))

    spans = []
    for i in range(40):
        a, b = sorted((moment(), moment()))
        spans.append((i % 3 and 1, i, a, b))
    points = [(rng.choice([0, 1, 1, 1]), i, moment()) for i in range(200)]
    got = joins.interval_join(
        frame("k long, p long, t timestamp_ntz", points),
        frame("k long, s long, a timestamp_ntz, b timestamp_ntz", spans),
        ["k"], "t", "a", "b", width_days=3,
    )
    want = [(s, p) for k, s, a, b in spans for j, p, t in points if j == k and a <= t <= b]
    assert rows(got, "s", "p") == sorted(want, key=repr)


def test_link_table_keeps_unlinked_stays(frame, stays):
    images = frame("subject_id long, hadm_id long, stay_id long, study_id long, dicom_id string", [(1, 10, 100, 5, "d")])
    note = "subject_id long, hadm_id long, stay_id long, note_id string"
    links = linkage.link_table(
        stays, images, frame(note, [(1, 10, 100, "x"), (1, 10, 101, "x")]), frame(note, [])
    )
    assert sorted(r["link"] for r in links.collect()) == ["discharge", "discharge", "image", *["stay"] * 4]
    assert rows(linkage.link_summary(links)) == [(3, 3, 4, 1, 1, 1, 0)]
    assert rows(linkage.link_summary(links, approximate=True)) == [(3, 3, 4, 1, 1, 1, 0)]
    keys = linkage.key_tables(links, debug_limit=3)
    assert rows(keys["stay"], "stay_id") == [(100,), (101,), (200,)]
    assert rows(keys["hadm"]) == [(1, 10), (2, 20)]
    assert rows(keys["subject"]) == [(1,), (2,)]


def test_chunk_of_stays(stays):
    assert rows(linkage.chunk_of_stays(stays, 1, 3), "stay_id") == [(101,), (200,)]


def test_details_keep_headers_and_rename_clashes(frame):
    header = frame("id long, seq int, name string", [(1, 1, "a"), (1, 2, "a2"), (2, 1, "b")])
    detail = frame("id long, seq int, subject_id long, dose double", [(1, 7, 0, 0.5), (1, 8, 0, 0.7), (9, 1, 0, 1.0)])
    got = joins.with_details(header, detail, ["id"], drop=["subject_id"])
    assert got.columns == ["id", "seq", "name", "detail_seq", "dose"]
    assert rows(got) == [
        (1, 1, "a", 7, 0.5), (1, 1, "a", 8, 0.7), (1, 2, "a2", 7, 0.5), (1, 2, "a2", 8, 0.7), (2, 1, "b", None, None)
    ]


def test_look_up_on_two_keys_of_other_names(frame):
    events = frame("code string, version int", [("0071", 9), ("0071", 10), ("x", 9)])
    names = frame("icd string, icd_version int, title string", [("0071", 9, "cholera")])
    got = joins.look_up(events, names, {"code": "icd", "version": "icd_version"}, ["title"])
    assert rows(got) == [("0071", 10, None), ("0071", 9, "cholera"), ("x", 9, None)]


def test_restrict_does_not_fan_out(frame):
    df = frame("a long, b string", [(1, "x"), (2, "y")])
    assert rows(joins.restrict(df, frame("a long", [(1,), (1,)]), ["a"])) == [(1, "x")]
