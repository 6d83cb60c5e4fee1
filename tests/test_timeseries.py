"""Pivot, cleaning, bins and sequences on literal rows."""

from datetime import timedelta

import pytest
from conftest import at, rows

from stayloom.operators import timeseries as ts

T0 = at("2150-01-01")
LABELS = ["HR", "it's", "never"]
READINGS = (
    "hadm_id long, stay_id long, charttime timestamp_ntz, label string, valuenum double, "
    "storetime timestamp_ntz, itemid long"
)


def reading(minute, label, value, stored=0, item=1, stay=1):
    return (1, stay, T0 + timedelta(minutes=minute), label, value, T0 + timedelta(minutes=stored), item)


def test_pivot_takes_the_first_stored_reading(frame):
    df = frame(
        READINGS,
        [
            reading(0, "HR", 80.0, stored=2), reading(0, "HR", 70.0, stored=1), reading(0, "it's", 1.0),
            reading(30, "HR", None, stored=1), reading(30, "HR", 60.0, stored=2),
            reading(60, "HR", 9.0, item=2), reading(60, "HR", 8.0, item=1), reading(60, "other", 5.0),
        ],
    )
    got = ts.with_elapsed_hours(ts.pivot_readings(df, LABELS))
    assert got.columns == ["hadm_id", "stay_id", "charttime", *LABELS, "frac_charttime"]
    assert rows(got, "frac_charttime", *[f"`{c}`" for c in LABELS]) == [
        (0.0, 70.0, 1.0, None), (0.5, None, None, None), (1.0, 8.0, None, None)
    ]
    skipping = ts.pivot_readings(df, ["HR"], skip_null=True)
    assert rows(skipping, "HR") == [(60.0,), (70.0,), (8.0,)]


def test_labels_are_filtered_before_the_pivot(frame):
    events = frame(READINGS, [reading(10, "HR", 1.0), reading(20, "unlisted", 2.0)])
    windows = frame(
        "hadm_id long, stay_id long, start_time timestamp_ntz, end_time timestamp_ntz",
        [(1, 1, T0, T0 + timedelta(hours=1))],
    )
    assert ts.time_series(events, windows, ["HR"]).count() == 1


def test_last_hours(frame):
    df = frame("stay_id long, frac_charttime double", [(1, 0.0), (1, 3.0), (1, 5.0), (2, 0.0)])
    assert rows(ts.last_hours(df)) == [(1, 3.0), (1, 5.0), (2, 0.0)]


SERIES = "stay_id long, charttime timestamp_ntz, frac_charttime double, HR double, RR double"


def point(stay, hour, hr=None, rr=None):
    return (stay, T0 + timedelta(hours=hour), float(hour), hr, rr)


def test_bins_have_gaps_and_empty_stays(frame):
    series = frame(SERIES, [point(1, 1, 10.0), point(1, 1.5, 20.0), point(1, 4, 30.0), point(1, 6, 99.0)])
    stays = frame("stay_id long", [(1,), (2,)])
    got = ts.time_bins(series, stays, ["HR", "RR"], 6, 2)
    assert rows(got) == [
        (1, 0, 15.0, None), (1, 1, None, None), (1, 2, 30.0, None),
        (2, 0, None, None), (2, 1, None, None), (2, 2, None, None),
    ]
    means = ts.bin_means(series, ["HR", "RR"], 6, 2)
    assert rows(ts.bin_vectors(means, stays, ["HR", "RR"], 3)) == [
        (1, [15.0, None, 30.0, None, None, None]), (2, [None] * 6)
    ]
    assert rows(ts.bin_vectors(means, stays, ["HR"], 3, "forward")) == [(1, [15.0, 15.0, 30.0]), (2, [None] * 3)]
    flat = ts.flatten_bins(means, stays, ["HR", "RR"], 3)
    assert flat.columns == ["stay_id", "HR_0", "HR_1", "HR_2", "RR_0", "RR_1", "RR_2"]
    with pytest.raises(ValueError):
        ts.time_bins(series, stays, ["HR"], 24, 5)


@pytest.mark.parametrize(
    "method, want",
    [
        ("forward", [10.0, 10.0, 30.0, 31.0, 31.0]), ("mean", [71 / 3, 10.0, 30.0, 31.0, 71 / 3]),
        ("median", [30.0, 10.0, 30.0, 31.0, 30.0]), ("zero", [0.0, 10.0, 30.0, 31.0, 0.0]),
    ],
)
def test_fill_within_a_stay(frame, method, want):
    means = frame("stay_id long, time_bin int, HR double", [(1, 1, 10.0), (1, 2, 30.0), (1, 3, 31.0), (1, 4, None)])
    got = ts.bin_vectors(means, means.select("stay_id"), ["HR"], 5, method).first()["values"]
    assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        ts.bin_vectors(means, means.select("stay_id"), ["HR"], 5, "nearest")


def test_fixed_interval_features_fill_with_train_medians(frame):
    series = frame(SERIES, [point(1, 0, 10.0), point(1, 3, 500.0), point(2, 0, 30.0), point(2, 2, 40.0)])
    stays = frame("stay_id long", [(1,), (2,), (3,)])
    bounds = {"HR": (0, 0, 350, 390)}
    got = ts.fixed_interval_features(series, stays, ["HR"], bounds, 4, 2)
    assert rows(got) == [(1, 10.0, 10.0), (2, 30.0, 40.0), (3, 20.0, 25.0)]
    learnt = ts.fixed_interval_features(series, stays, ["HR"], bounds, 4, 2, median_stays=stays.where("stay_id = 2"))
    assert rows(learnt)[2] == (3, 30.0, 40.0)


def test_preprocess_masks_before_filling(frame):
    series = frame(SERIES, [point(1, 0, None, 5.0), point(1, 1, 80.0), point(1, 2), point(1, 9, 1.0, 1.0), point(2, 0)])
    got = ts.preprocess(series, ["HR", "RR"], 5, {}, {"HR": 70.0, "RR": 7.0})
    assert rows(got, "stay_id", "frac_charttime", "HR", "RR", "mask_HR", "mask_RR") == [
        (1, 0.0, 80.0, 5.0, 0, 1), (1, 1.0, 80.0, 5.0, 1, 0), (1, 2.0, 80.0, 5.0, 0, 0), (2, 0.0, 70.0, 7.0, 0, 0)
    ]


@pytest.mark.parametrize("method, want", [("mean", 15.0), ("median", 20.0), ("zero", 0.0)])
def test_stay_level_fill(frame, method, want):
    series = frame(SERIES, [point(1, 0, 5.0), point(1, 1, 20.0), point(1, 2, 20.0), point(1, 3), point(2, 0, 99.0)])
    got = ts.impute(series, ["HR"], method, key="stay_id")
    assert got.where("stay_id = 1 AND frac_charttime = 3").first()["HR"] == want


def test_column_fill(frame):
    series = frame(SERIES, [point(1, 0, 5.0), point(1, 1, 20.0), point(2, 2, 50.0), point(3, 3)])
    assert ts.impute(series, ["HR"], "mean").where("stay_id = 3").first()["HR"] == 25.0
    assert ts.impute(series, ["HR"], "median").where("stay_id = 3").first()["HR"] == 20.0
    with pytest.raises(ValueError):
        ts.impute(series, ["HR"], "nearest")


def test_padding_cuts_and_fills(frame):
    series = frame(SERIES, [point(1, h, float(h)) for h in range(1, 6)] + [point(2, 0, 7.0)])
    got = ts.padded_sequences(series, ["HR"], 3)
    assert rows(got) == [(1, [1.0, 2.0, 3.0], [1, 1, 1]), (2, [7.0, 0.0, 0.0], [1, 0, 0])]


def test_tensor_rows(frame):
    series = frame(SERIES, [point(1, 0, 10.0), point(1, 1)])
    prepared = ts.preprocess(series, ["HR"], 24, {}, {"HR": 10.0})
    got = ts.sequence_tensor(prepared, ["HR"], {"HR": (8.0, 2.0)}, 3).first()
    assert got["tensor"] == [[1.0, 1.0, 0.0], [1.0, 0.0, 1.0], [0.0, 0.0, 0.0]]
    assert got["input_mask"] == [1, 1, 0]


def test_pad_length_is_cut_down(frame):
    series = frame(SERIES, [point(s, h) for s in range(4) for h in range(s + 1)])
    assert ts.pad_length(series, 0.5).first()["pad_length"] == 2
