"""Windows, cohort rules and outcomes on literal rows."""

from datetime import timedelta

import pytest
from conftest import at, rows

from stayloom.config import TrainingConfig
from stayloom.operators import cohort, outcomes, windows

STAY = (
    "stay_id long, subject_id long, intime timestamp_ntz, outtime timestamp_ntz, earliest_intime timestamp_ntz, "
    "los double, age int, hospital_expire_flag int, deathtime timestamp_ntz, dod timestamp_ntz"
)
IN, OUT = at("2150-01-10"), at("2150-01-14")


def stay(stay_id, subject=1, intime=IN, outtime=OUT, early=None, los=4.0, age=50, flag=0, death=None, dod=None):
    return (stay_id, subject, intime, outtime, early or intime, los, age, flag, death, dod)


@pytest.mark.parametrize(
    "start, end, want",
    [
        (None, None, (at("2150-01-09"), OUT)),
        (0, 24, (IN, at("2150-01-11"))),
        (-6, 500, (at("2150-01-09 18:00:00"), OUT)),
        (-240, 24, (at("2150-01-09"), at("2150-01-11"))),
        (12, None, (at("2150-01-10 12:00:00"), OUT)),
    ],
)
def test_windows(frame, start, end, want):
    base = frame(STAY, [stay(1, early=at("2150-01-09"))])
    assert rows(windows.stay_windows(base, start, end), "start_time", "end_time") == [want]


def test_window_is_open_at_both_ends(frame):
    bounds = windows.stay_windows(frame(STAY, [stay(1)]), 0, 24)
    second = timedelta(seconds=1)
    times = [IN, IN + second, at("2150-01-11") - second, at("2150-01-11")]
    events = frame("stay_id long, charttime timestamp_ntz", [(1, t) for t in times])
    got = windows.in_window(events, bounds, ["stay_id"], "charttime")
    assert rows(got, "charttime") == [(times[1],), (times[2],)]


def test_icu_expire_flag(frame):
    inside, edge, outside = at("2150-01-12"), OUT, at("2150-02-01")
    cases = {
        1: (stay(1, flag=0, death=inside), 0),
        2: (stay(2, flag=1, death=inside), 1),
        3: (stay(3, flag=1, death=edge), 0),
        4: (stay(4, flag=1, death=outside, dod=inside), 0),
        5: (stay(5, flag=1, dod=inside), 1),
        6: (stay(6, flag=1), 0),
        7: (stay(7, flag=None, death=inside), 1),
        8: (stay(8, flag=None), 0),
    }
    df = frame(STAY, [s for s, _ in cases.values()])
    got = dict(rows(df.select("stay_id", outcomes.icu_expire_flag())))
    assert got == {k: want for k, (_, want) in cases.items()}


def test_los_binary_is_strict(frame):
    df = frame(STAY, [stay(1, los=3.0), stay(2, los=3.01)])
    assert rows(outcomes.outcomes(df), "stay_id", "los_binary") == [(1, 0), (2, 1)]


def test_readmission(frame):
    limit = OUT + timedelta(days=30)
    late = limit + timedelta(microseconds=1)
    df = frame(
        STAY,
        [
            stay(1, 1), stay(2, 1, limit, limit),
            stay(3, 2), stay(4, 2, late, late),
            stay(5, 3), stay(6, 3),
            stay(7, 4, IN, OUT), stay(8, 4, late, late), stay(9, 4, at("2150-01-12"), OUT),
        ],
    )
    assert dict(rows(outcomes.readmission(df, 30))) == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0, 9: 0}


def test_readmission_equals_exists_on_a_hot_subject(frame, spark):
    data = [
        stay(i, 1 if i % 3 else 1 + i, IN + timedelta(days=37 * i % 400), IN + timedelta(days=37 * i % 400 + i % 5))
        for i in range(120)
    ]
    df = frame(STAY, data)
    df.createOrReplaceTempView("w")
    want = spark.sql(
        """SELECT stay_id, CASE WHEN EXISTS (SELECT 1 FROM w b WHERE b.subject_id = w.subject_id
               AND b.intime > w.intime AND b.intime <= w.outtime + INTERVAL 7 DAYS) THEN 1 ELSE 0 END FROM w"""
    )
    assert rows(outcomes.readmission(df, 7)) == rows(want)


def test_cohort(frame):
    df = frame(STAY, [stay(1, age=18), stay(2, age=17), stay(3, age=90), stay(4, los=0.5), stay(5)])
    counts = frame("stay_id long", [(1,), (3,), (3,)])
    nothing = frame("stay_id long", [])
    radiology = frame("stay_id long", [(3,), (9,)])
    presence = cohort.modality_presence(df, counts, nothing, nothing, radiology)
    assert rows(presence) == [(1, 1, 0, 0), (2, 0, 0, 0), (3, 2, 0, 1), (4, 0, 0, 0), (5, 0, 0, 0)]
    config = TrainingConfig(age_lower=18, age_upper=90, los_lower=1)
    included = cohort.included_stays(df, presence, config)
    assert rows(included) == [(1,), (3,), (5,)]
    config = TrainingConfig(drop_missing_ts=True, drop_missing_text=True)
    assert rows(cohort.included_stays(df, presence, config)) == [(3,)]
    assert rows(cohort.cohort_counts(df, included)) == [(5, 3)]


def test_fan_out_audit(frame):
    tables = {"good": (frame("k long", [(1,), (2,)]), "k"), "bad": (frame("k long", [(1,), (1,), (2,)]), "k")}
    assert rows(cohort.fan_out_audit(tables, 2)) == [("bad", 3, 2, 1.5, 1), ("good", 2, 2, 1.0, 0)]
    assert rows(cohort.fan_out_audit(tables, 0), "rows_per_stay") == [(0.0,), (0.0,)]
