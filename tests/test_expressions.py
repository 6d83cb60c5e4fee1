"""Column expressions on literal rows."""

from conftest import at, rows

from stayloom.functions import times, values


def test_coerce_datetimes_by_column_name(frame):
    df = frame(
        "id long, charttime string, StudyDate string, dod string, icd_code string",
        [(1, "2150-01-02 03:04:05", "bad", None, "0071"), (2, "", "2150-01-02", "2151-06-01", "V10")],
    )
    got = times.coerce_datetimes(df)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", *["timestamp_ntz"] * 3, "string"]
    assert rows(got) == [
        (1, at("2150-01-02 03:04:05"), None, None, "0071"),
        (2, None, at("2150-01-02"), at("2151-06-01"), "V10"),
    ]


def test_packed_datetime_pads_the_time(frame):
    df = frame("d int, t double", [(21500102, 12.0), (21500102, 93015.5), (21500102, 235959.999)])
    got = df.select(times.packed_datetime("d", "t").alias("x"))
    assert [r[0] for r in got.collect()] == [
        at("2150-01-02 00:00:12"), at("2150-01-02 09:30:15"), at("2150-01-02 23:59:59")
    ]


def test_hours_count_second_boundaries(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(at("2150-01-01 00:00:00.900"), at("2150-01-01 00:00:02.100"))])
    assert rows(df.select(times.hours_between("a", "b"))) == [(2 / 3600,)]


def test_earliest_skips_null(frame):
    df = frame("a timestamp_ntz, b timestamp_ntz", [(at("2150-01-02"), None), (at("2150-01-02"), at("2150-01-01"))])
    assert rows(df.select(times.earliest("a", "b").alias("x"))) == [(at("2150-01-01"),), (at("2150-01-02"),)]


def test_regroup_takes_the_first_group(frame):
    df = frame("race string", [("WHITE HISPANIC",), ("HISPANIC OR BLACK",), ("UNKNOWN",), (None,)])
    got = df.select("race", values.regroup("race").alias("g"))
    assert dict(rows(got)) == {"WHITE HISPANIC": "WHITE", "HISPANIC OR BLACK": "HISPANIC", "UNKNOWN": "OTHER", None: "OTHER"}


def test_clip(frame):
    df = frame("x double", [(-1.0,), (5.0,), (50.0,), (110.0,), (200.0,), (float("nan"),), (None,)])
    got = [r[0] for r in df.select(values.clip("x", (0, 10, 100, 150))).collect()]
    assert got == [None, 10.0, 50.0, 100.0, None, None, None]


def test_band_upper_ends_belong_below(frame):
    df = frame("age int", [(65,), (66,), (85,), (86,), (None,)])
    assert [r[0] for r in df.select(values.band("age")).collect()] == [
        "Age<=65", "65<Age<=85", "65<Age<=85", "Age>85", None
    ]


def test_thresholds_differ_at_the_threshold(frame):
    df = frame("p double", [(0.5,), (0.51,)])
    assert rows(df.select(values.above("p"), values.at_least("p"))) == [(0, 1), (1, 1)]


def test_paths(frame):
    df = frame("subject_id long, study_id long, dicom_id string", [(10000032, 50414267, "a-b.c")])
    path = values.image_path("subject_id", "study_id", "dicom_id", ".dcm")
    got = df.select(path, values.with_extension(path, ".jpg"), values.file_name(path))
    assert rows(got) == [
        ("files/p10/p10000032/s50414267/a-b.c.dcm", "files/p10/p10000032/s50414267/a-b.c.jpg", "a-b.c.dcm")
    ]


def test_number_text(frame):
    df = frame("x double", [(0.0,), (36.6,), (100.0,), (0.0004,), (12345678.5,), (-20000000.0,), (None,)])
    assert [r[0] for r in df.select(values.number_text("x")).collect()] == [
        "0.0", "36.6", "100.0", "0.0004", "12345678.5", "-20000000.0", None
    ]


def test_prefixed_keeps_the_other_names(frame):
    df = frame("id long, `Lung Lesion` double", [(1, 0.0)])
    assert values.prefixed(df, "chexpert_", ["Lung Lesion"]).columns == ["id", "chexpert_Lung Lesion"]


def test_clip_outliers_only_touches_bounded_columns(frame):
    df = frame("a double, b double", [(500.0, 500.0)])
    got = values.clip_outliers(df, {"a": (0, 0, 100, 200), "missing": (0, 0, 1, 1)})
    assert rows(got) == [(None, 500.0)]
