"""Texts, records and prompts, word for word."""

import pytest
from conftest import at, rows

from stayloom.operators import checks, profiles
from stayloom.sources.sinks import read_records, write_records

VITALS = (
    "stay_id long, charttime timestamp_ntz, frac_charttime double, `Heart Rate` double, "
    "`Non Invasive Blood Pressure systolic` double, `Non Invasive Blood Pressure diastolic` double, "
    "`Non Invasive Blood Pressure mean` double"
)


@pytest.fixture
def tabular(frame):
    return frame(
        "stay_id long, intime timestamp_ntz, age int, gender string, race string, marital_status string, "
        "language string, insurance string, hospital_expire_flag int, los_binary int",
        [
            (7, at("2150-01-01"), 60, "F", "WHITE", None, "ENGLISH", "Medicare", 0, 1),
            (9, at("2150-01-01"), 41, "M", "ASIAN", "SINGLE", "?", "Other", 1, 0),
        ],
    )


@pytest.fixture
def series(frame):
    return frame(
        VITALS,
        [
            (7, at("2150-01-01 01:00:00"), 0.0, 50.0, None, None, None),
            (7, at("2150-01-01 05:00:00"), 4.0, 80.0, 120.0, None, None),
            (7, at("2150-01-01 06:00:00"), 5.0, None, None, None, None),
        ],
    )


@pytest.fixture
def reports(frame):
    return frame(
        "stay_id long, note_id string, charttime timestamp_ntz, text string",
        [
            (7, "b", at("2150-01-01 10:10:00"), "clear"), (7, "a", at("2150-01-01 10:10:00"), "clear"),
            (7, "c", at("2150-01-01 02:00:00"), "early"),
        ],
    )


@pytest.fixture
def images(frame):
    return frame(
        "stay_id long, subject_id long, study_id long, dicom_id string, StudyDatetime timestamp_ntz",
        [(7, 10000032, 5, "old", at("2150-01-01")), (7, 10000032, 6, "new", at("2150-01-02"))],
    )


DEMO = (
    "Patient Demographics:\n        - Age: 60\n        - Gender: F\n        - Race: WHITE\n"
    "        - Marital Status: nan\n        - Language: ENGLISH\n        - Insurance: Medicare\n        "
)
VITAL = (
    "Vital Signs:\n- Time from ICU Admission: 4.0 hours\n    - Heart Rate: 80.0\n"
    "    - Non-invasive Blood Pressure (Systolic/Diastolic/Mean): 120.0 / nan / nan\n"
    "- Time from ICU Admission: 5.0 hours\n"
)
IMAGE = "Chest X-Ray Images:\n- The uploaded image is the most recent chest X-ray image.\n"
REPORT = (
    "Radiology Reports:\n- Time from ICU Admission: 2.0 hours\n    - Report Text: early\n"
    "- Time from ICU Admission: 10.17 hours\n    - Report Text: clear\n"
)


def test_blocks(tabular, series, reports):
    assert rows(profiles.demographic_block(tabular))[0] == (7, DEMO)
    assert rows(profiles.vital_block(series)) == [(7, 0, VITAL)]
    assert rows(profiles.report_block(reports, tabular)) == [(7, 0, REPORT)]


def test_profile(tabular, series, images, reports):
    got = {r["stay_id"]: r for r in profiles.patient_profiles(tabular, series, images, reports).collect()}
    assert got[7]["context"] == "\n".join([DEMO, VITAL, IMAGE, REPORT])
    assert got[9]["context"].startswith("Patient Demographics:") and got[9]["last"]


def test_long_profile_in_parts(tabular, series, images, reports):
    parts = (
        profiles.patient_profiles(tabular, series, images, reports, part_size=1)
        .where("stay_id = 7").orderBy("part").collect()
    )
    assert [r["part"] for r in parts] == [0, 1, 2]
    assert "".join(r["context"] for r in parts) == "\n".join([DEMO, VITAL, IMAGE, REPORT])
    assert [r["last"] for r in parts] == [False, False, True]


def test_records_and_prompts(spark, tmp_path, tabular, series, images, reports):
    profile = profiles.patient_profiles(tabular, series, images, reports)
    records = profiles.qa_records(profile, images, tabular)
    write_records(records, str(tmp_path / "qa"))
    back = read_records(spark, str(tmp_path / "qa"), profiles.RECORD_SCHEMA)
    assert back.count() == 2
    first = back.where("id = 1").first()
    assert first["image"] == "files/p10/p10000032/s6/new.jpg"
    assert first["answer"] == {"hospital_expire_flag": 0, "los_binary": 1}
    prompt = profiles.prompts(back, "hospital_expire_flag", "plain", "physician").where("id = 1").first()
    assert prompt["prompt"] == (
        "Based on the information collected during current ICU stay, \n" + first["context"]
        + "\nWill the patient die during current hospital admission?\nAnswer the question using only yes or no."
    )
    assert prompt["image_file"] == "new.jpg"
    other = profiles.prompts(back, "los_binary", "confident").where("id = 2").first()
    assert other["prompt"].endswith(
        "\n<image>Will this patient's ICU stay exceed three days?\nProvide a confident and definitive answer."
        "Answer the question using only yes or no without any additional explanation"
    )
    assert other["image_file"] is None and other["system"] is None
    assert profiles.prompts(back, "los_binary", system="Answer as a nurse.").first()["system"] == "Answer as a nurse."
    assert profiles.prompts(back, "los_binary", system="physician").first()["system"] == profiles.SYSTEM_TEXTS["physician"]


def test_prompt_of_a_record_in_parts(tabular, series, images, reports):
    profile = profiles.patient_profiles(tabular, series, images, reports, part_size=1)
    split = profiles.prompts(profiles.qa_records(profile, images, tabular), "los_binary")
    whole = profiles.prompts(
        profiles.qa_records(profiles.patient_profiles(tabular, series, images, reports), images, tabular), "los_binary"
    )
    joined = "".join(r["prompt"] for r in split.where("id = 1").orderBy("part").collect())
    assert joined == whole.where("id = 1").first()["prompt"]


def test_fingerprint_ignores_order_not_repeats(frame):
    a = frame("x long, y string", [(1, "a"), (2, None), (2, None)])
    same = frame("y string, x long", [(None, 2), ("a", 1), (None, 2)])
    other = frame("x long, y string", [(1, "a"), (1, "a"), (2, None)])
    assert checks.compare(a, same) == (True, "identical")
    assert checks.compare(a, other) == (False, "same shape, different content")
    assert checks.compare(a, a.limit(1))[0] is False
    assert checks.compare(a, a.drop("y"))[0] is False
    assert rows(checks.difference(a, other)) == [(1, 1)]
    assert rows(checks.difference(a, same)) == [(0, 0)]


def test_linked_images_are_made_once(spark):
    from stayloom.driver.texts import linked_images
    from stayloom.driver.views import Views

    views = Views(spark, "/root/testdata/sf0.001")
    assert linked_images(views) is linked_images(views)


def test_records_write_texts_after_the_joins(frame, tabular, series, images, reports):
    """Gathered profiles give the same records, and no exchange or sort carries the demographic text."""
    doubled = tabular.unionByName(tabular.where("stay_id = 9")).unionByName(tabular.limit(1).selectExpr("CAST(NULL AS LONG) AS stay_id", *tabular.columns[1:]))
    for part_size in (None, 1):
        args = (doubled, series, images, reports, "stay_id", part_size)
        whole = profiles.qa_records(profiles.patient_profiles(*args), images, doubled)
        late = profiles.qa_records(profiles.gathered_profiles(*args), images, doubled)
        assert rows(late, "id", "part", "last", "context", "image") == rows(whole, "id", "part", "last", "context", "image")
        text = late._jdf.queryExecution().sparkPlan().toString()
        assert "Patient Demographics" in text and "Patient Demographics" not in text[text.index("Join") :]
