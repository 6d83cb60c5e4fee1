"""Physical plans: pushdown, no Python in the plan, no products, split hot keys."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayloom.driver import QUERIES
from stayloom.driver.views import Views
from stayloom.operators import cohort, images, joins, linkage, outcomes, timeseries, windows
from stayloom.session import settle, tune

DATA = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def views(spark):
    return Views(spark, DATA)


@pytest.mark.parametrize("name", ["frac_hours", "link_interval_join", "image_index", "outcomes", "time_bin_mean", "subgroup_metrics"])
def test_no_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_label_filter_and_columns_reach_the_scan(spark, views, tmp_path):
    views["chartevents"].write.parquet(str(tmp_path / "c"))
    events = spark.read.parquet(str(tmp_path / "c"))
    text = plan(timeseries.windowed_readings(events, views.windows, ["Heart Rate", "Respiratory Rate"]))
    scan = next(line for line in text.splitlines() if "FileScan parquet" in line and "valuenum" in line)
    assert "In(label" in scan and "subject_id" not in scan


def test_pivot_is_one_shuffle(spark, views):
    text = plan(timeseries.pivot_readings(views["chartevents"], ["Heart Rate", "Respiratory Rate"]))
    after = text[: text.index("Scan parquet")]
    assert after.count("hashpartitioning(hadm_id") == 1


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
}


@pytest.fixture
def hot(spark):
    """Low thresholds, and events a third of which belong to stay 0."""
    before = {k: spark.conf.get(k, None) for k in HOT}
    for k, v in HOT.items():
        spark.conf.set(k, v)
    start = datetime(2150, 1, 1)
    events = spark.range(0, 60000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).cast("long").alias("stay_id"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") % 5000).cast("int"))).alias("charttime"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    stays = spark.range(500).select(
        F.col("id").alias("stay_id"),
        F.lit(start - timedelta(days=1)).cast("timestamp_ntz").alias("start_time"),
        F.lit(start + timedelta(days=9)).cast("timestamp_ntz").alias("end_time"),
    )
    yield events, stays
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_stay_is_split_in_the_window_join(hot):
    events, stays = hot
    df = windows.in_window(events, stays, ["stay_id"], "charttime")
    assert len(df.collect()) == 60000
    assert "skew=true" in plan(df)


def test_hot_stay_is_split_below_the_pivot(hot):
    """The pivot groups by stay and time, so the split join costs one more shuffle and is still done."""
    events, stays = hot
    readings = windows.in_window(
        events.selectExpr("stay_id AS hadm_id", "*", "'HR' AS label", "1.0D AS valuenum"), stays, ["stay_id"], "charttime"
    )
    df = timeseries.pivot_readings(readings, ["HR"])
    assert len(df.collect()) == events.select("stay_id", "charttime").distinct().count()
    assert "skew=true" in plan(df)


def test_hot_stay_is_split_in_the_cohort_join(hot):
    events, stays = hot
    df = joins.restrict(events, stays, ["stay_id"])
    assert len(df.collect()) == 60000
    assert "skew=true" in plan(df)


def test_hot_header_is_split_in_the_detail_join(hot):
    events, stays = hot
    df = joins.with_details(stays.select("stay_id", "start_time"), events, ["stay_id"])
    assert len(df.collect()) == 60000
    assert "skew=true" in plan(df)


def test_hot_subject_is_spread_over_periods(spark, hot):
    """All images and stays belong to one subject; tasks see only the stays of their weeks."""
    start = F.lit(datetime(2150, 1, 1)).cast("timestamp_ntz")
    points = spark.range(0, 3000).select(
        F.lit(1).alias("k"), F.col("id").alias("p"), (start + F.make_dt_interval(F.col("id").cast("int"))).alias("t")
    )
    spans = spark.range(0, 1500).select(
        F.lit(1).alias("k"), F.col("id").alias("s"),
        (start + F.make_dt_interval((F.col("id") * 2).cast("int"))).alias("a"),
        (start + F.make_dt_interval((F.col("id") * 2 + 3).cast("int"))).alias("b"),
    )
    df = joins.interval_join(points, spans, ["k"], "t", "a", "b")
    assert "hashpartitioning(" in plan(df) and "_period#" in plan(df)
    assert df.count() == 4 * 1500 - 2


def test_readmission_of_a_hot_subject_runs_per_slice(spark):
    df = spark.range(40).select(
        F.col("id").alias("stay_id"), F.lit(1).alias("subject_id"),
        (F.lit(datetime(2150, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.col("id").cast("int"))).alias("intime"),
    ).withColumn("outtime", F.col("intime"))
    got = outcomes.readmission(df, 0)
    assert "_slice" in plan(got)
    assert got.where("readmission = 1").count() == 0
    assert outcomes.readmission(df, 1).where("readmission = 1").count() == 39


@pytest.fixture
def filtered(spark):
    """Joins that shuffle, with filters by the other side's keys for small tables too."""
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1KB"}
    before = {k: spark.conf.get(k, None) for k in low}
    for k, x in low.items():
        spark.conf.set(k, x)
    yield
    for k, x in before.items():
        spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_rows_a_written_link_does_not_name_are_not_shuffled(spark, filtered):
    """Metadata, windows, paths and findings are filtered by the link's keys below their exchanges."""
    taken = F.lit(datetime(2150, 1, 2)).cast("timestamp_ntz")
    ids = spark.range(2000).select(
        (F.col("id") % 50).alias("subject_id"), (F.col("id") % 400).alias("study_id"),
        F.concat(F.lit("d"), F.col("id")).alias("dicom_id"), F.col("id"),
    )
    metadata = settle(ids.select("subject_id", "study_id", "dicom_id", taken.alias("StudyDatetime")))
    link = settle(ids.where("id % 100 = 7").select(F.col("id").alias("stay_id"), "subject_id", "study_id", "dicom_id"))
    bounds = settle(ids.select(
        F.col("id").alias("stay_id"), (taken - F.expr("INTERVAL 1 DAY")).alias("start_time"),
        (taken + F.expr("INTERVAL 1 DAY")).alias("end_time"),
    ))
    paths = settle(ids.select("subject_id", "study_id", "dicom_id", F.concat(F.lit("p"), F.col("id")).alias("path")))
    studies = settle(ids.where("id < 400").select("subject_id", "study_id", F.lit("r").alias("path"), F.lit(1.0).alias("Edema")))
    got = images.image_index(
        metadata, link, bounds, paths, studies.select("subject_id", "study_id", "path"),
        {"chexpert": studies, "negbio": studies}, ["Edema"],
    )
    assert got._jdf.queryExecution().optimizedPlan().toString().count("might_contain(") >= 6
    rows = got.collect()
    assert len(rows) == 20 and {r["image_path"] for r in rows} == {f"p{i}" for i in range(7, 2000, 100)}
    assert all(r["text_path"] == "r" and r["chexpert_Edema"] == r["negbio_Edema"] == 1.0 for r in rows)


def test_stays_without_a_note_are_not_shuffled_for_the_links(spark, filtered):
    moment = F.lit(datetime(2150, 1, 2)).cast("timestamp_ntz")
    ids = spark.range(2000).select((F.col("id") % 50).alias("subject_id"), F.col("id").alias("hadm_id"), F.col("id").alias("stay_id"))
    stays = settle(ids.select("*", moment.alias("earliest_intime"), moment.alias("outtime")))
    notes = settle(ids.where("hadm_id % 100 = 7").select(
        "subject_id", "hadm_id", F.when(F.col("hadm_id") > 100, F.lit("n")).alias("note_id"), moment.alias("charttime")
    ))
    for link in (linkage.link_discharge_notes(stays, notes), linkage.link_radiology_notes(stays, notes)):
        assert "might_contain(" in link._jdf.queryExecution().optimizedPlan().toString()
        assert {(r["stay_id"], r["note_id"]) for r in link.collect()} == {(7, None), *((i, "n") for i in range(107, 2000, 100))}


@pytest.mark.parametrize("name", ["cohort_select", "cohort_counts", "qa_records", "prompt_text"])
def test_windows_are_joined_once(spark, name):
    """Every step after the writing of the windows reads the written table, not patients again."""
    assert "c_custkey" not in QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()


def scans(df):
    """The optimized plan, where every table that is read is a relation."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tables_of_an_export_are_not_joined_in_one_plan(spark):
    """Images, notes and events are settled before the stays are exported, so that their filters are gone by then."""
    plan_of = scans(QUERIES["export_included"](spark, DATA))
    assert not any(c in plan_of for c in ("l_orderkey", "doc_id", "event_id", "note_id", "dicom_id"))


def test_each_modality_is_counted_from_written_stays(spark):
    ids = spark.range(6).select((F.col("id") % 3).alias("stay_id"))
    joined = ids.join(spark.range(2).select(F.col("id").alias("stay_id")), "stay_id")
    got = cohort.modality_presence(ids.distinct(), joined, joined, ids, ids)
    assert "Join" not in scans(got)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 2, 2, 4), (1, 2, 2, 4), (2, 0, 0, 4)]


def test_tables_of_an_audit_are_not_joined_in_one_plan(spark):
    tables = {
        name: (spark.range(9).join(spark.range(n).select("id"), "id").withColumnRenamed("id", "k"), "k")
        for name, n in (("a", 4), ("b", 6))
    }
    got = cohort.fan_out_audit(tables, 2)
    assert "Join" not in scans(got) and "Aggregate" not in scans(got)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 4, 4, 2.0, 0), ("b", 6, 6, 3.0, 0)]


def test_compressed_keys_are_not_broadcast_by_their_size_on_disk(spark):
    """Where the driver is spared, a settled table counts for more than its files, which are compressed."""
    path = settle(spark.range(1_000_000).select("id", F.lit("x").alias("same"))).inputFiles()
    on_disk = sum(Path(f.removeprefix("file://")).stat().st_size for f in path)
    try:
        QUERIES["export_included"](spark, DATA)
        table = spark.read.parquet(*path)
        assert int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= 4 * on_disk
        assert int(spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits")) <= 8 * 2 * 1024**2
    finally:
        tune(spark)
