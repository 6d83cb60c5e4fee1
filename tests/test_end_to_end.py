"""From source folders to evaluation tables, through the command line."""

import clinic
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stayloom.__main__ import main
from stayloom.config import FINDINGS, VITAL_SIGNS
from stayloom.operators import features
from stayloom.operators.models import ModelStore, logistic_search
from stayloom.plans import experiment, master, stays, training
from stayloom.sources import folders, ingest, sinks


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("clinic")
    paths = clinic.build(root)
    output = str(root / "master")
    arguments = [f"--{k.replace('_', '-')}-path={v}" for k, v in paths.items()]
    main(["master", *arguments, "--output-dir", output])
    main(["training", "--input-dir", output, "--output-dir", str(root / "training"), "--start-diff", "0", "--end-diff", "24"])
    return root, paths, arguments


def read(spark, world, step, name):
    return spark.read.parquet(f"{world[0]}/{step}/{name}.parquet")


def test_scan_skips_other_files_and_types_codes(spark, world):
    tables = folders.scan_folder(spark, world[1]["hosp"], cast_datetimes=True)
    assert len(tables) == 20 and "admissions" in tables
    assert dict(tables["diagnoses_icd"].dtypes)["icd_code"] == "string"
    assert tables["diagnoses_icd"].first()["icd_code"] == "0071"
    assert dict(tables["admissions"].dtypes)["edregtime"] == "timestamp_ntz"
    assert tables["admissions"].first()["admission_type"] == 'URGENT, "URGENT"'
    assert spark.table("`d_icd_diagnoses`").count() == 1
    assert set(folders.scan_folder(spark, world[1]["cxr"])) == {"cxr-record-list", "cxr-study-list"}


def test_notes_keep_their_line_breaks(spark, world):
    note = folders.scan_folder(spark, world[1]["note"], cast_datetimes=True)
    assert note["discharge"].count() == clinic.STAYS
    assert note["discharge"].where("note_id = 'DS3'").first()["text"] == 'Discharged.\nDay, "3"'


def test_every_master_table_is_written(spark, world):
    names = [e.name for e in master.EXPORTS] + [*master.IMAGE_EXPORTS, "dsnotes", "radnotes", "list_ids", "cxr_study_datetime"]
    assert len(names) == 30
    for name in names:
        assert folders.is_written(spark, f"{world[0]}/master/{name}.parquet"), name


def test_master_is_restricted_and_enriched(spark, world):
    assert read(spark, world, "master", "patients").where("subject_id = 99999").count() == 0
    assert read(spark, world, "master", "transfers").count() == clinic.STAYS
    assert read(spark, world, "master", "labevents").count() == clinic.STAYS // 2
    assert read(spark, world, "master", "labevents").columns[-3:] == ["lab_label", "fluid", "category"]
    titles = read(spark, world, "master", "diagnoses_icd").groupBy("long_title").count()
    assert rows(titles) == [("Title, quoted", 12), (None, 12)]
    emar = read(spark, world, "master", "emar")
    assert emar.columns == ["subject_id", "hadm_id", "emar_id", "emar_seq", "detail_emar_seq", "dose_given"]
    assert emar.count() == 12 * 3 + 12
    assert "detail_hadm_id" in read(spark, world, "master", "prescriptions").columns
    assert read(spark, world, "master", "chartevents").columns[-3:] == ["label", "category", "unitname"]
    assert read(spark, world, "master", "cxr_metadata").columns[-1] == "StudyDatetime"
    assert read(spark, world, "master", "radnotes").columns[-3:] == ["field_name", "field_value", "field_ordinal"]


def test_finished_tables_are_kept(spark, world, capsys):
    main(["master", *world[2], "--output-dir", f"{world[0]}/master"])
    assert "written" not in capsys.readouterr().out


def test_unfinished_table_is_written_again(spark, world, tmp_path):
    (tmp_path / "t.parquet").mkdir()
    assert sinks.write_table(spark.range(3), f"{tmp_path}/t.parquet")
    assert not sinks.write_table(spark.range(5), f"{tmp_path}/t.parquet")
    assert sinks.write_table(spark.range(5), f"{tmp_path}/t.parquet", overwrite=True)
    assert spark.read.parquet(f"{tmp_path}/t.parquet").count() == 5


def test_debug_limit_restricts_every_table_to_one_cohort(spark, world, tmp_path):
    main(["master", *world[2], "--output-dir", str(tmp_path), "--debug-limit", "4"])
    for name, count in (("icustays", 4), ("admissions", 4), ("patients", 2), ("dsnotes", 4)):
        assert spark.read.parquet(f"{tmp_path}/{name}.parquet").count() == count


def test_training_tables(spark, world):
    tabular = read(spark, world, "training", "tabular")
    assert tabular.count() == tabular.select("stay_id").distinct().count() == clinic.STAYS
    assert tabular.columns[:9] == ["subject_id", "hadm_id", "stay_id", "age", "gender", "race", "marital_status", "language", "insurance"]
    assert tabular.columns[-3:] == ["icu_expire_flag", "los_binary", "readmission"]
    series = read(spark, world, "training", "time_series")
    assert series.columns == ["hadm_id", "stay_id", "charttime", *VITAL_SIGNS, "frac_charttime"]
    assert series.where("stay_id = 30003").count() == 0
    assert series.groupBy("stay_id").agg(F.min("frac_charttime").alias("m")).where("m <> 0").count() == 0
    index = read(spark, world, "training", "cxr_index")
    assert {f"chexpert_{f}" for f in FINDINGS} <= set(index.columns)
    assert index.count() == index.select("stay_id", "dicom_id").distinct().count() > 0
    assert read(spark, world, "training", "notes_discharge").count() == clinic.STAYS
    radiology = read(spark, world, "training", "notes_radiology")
    assert radiology.count() == 3 * clinic.STAYS
    fields = radiology.where("note_id = 'RR0-0'").first()["detail_fields"]
    assert [f["ordinal"] for f in fields] == [1, 2]


def test_missing_input_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="chartevents"):
        training.export_training(spark, str(tmp_path), str(tmp_path))


def test_matrix_round_trip_and_stay_groups(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, 2.0), (2, None, 3.0)], "stay_id long, `Heart Rate_0` double, b double")
    sinks.write_matrix(df, f"{tmp_path}/m", ["Heart Rate_0", "b"])
    assert rows(sinks.read_matrix(spark, f"{tmp_path}/m")) == rows(df)
    sinks.write_by_stay(df, f"{tmp_path}/g", 2)
    sinks.write_by_stay(df.where("stay_id = 1").withColumn("b", F.lit(9.0)), f"{tmp_path}/g", 2)
    assert rows(spark.read.parquet(f"{tmp_path}/g"), "stay_id", "b") == [(1, 9.0), (2, 3.0)]


def test_sorted_export_is_in_order(spark, world):
    df = read(spark, world, "master", "chartevents").select("stay_id", "charttime")
    got = [tuple(r) for r in sinks.sorted_by(df, ["stay_id", "charttime"]).collect()]
    assert got == sorted(got)
    down = [tuple(r) for r in sinks.sorted_by(df, ["stay_id", "charttime"], ascending=False).collect()]
    assert down == sorted(got, reverse=True)


def test_features_to_evaluation(spark, world, tmp_path):
    folder = f"{world[0]}/training"
    out = str(tmp_path / "emb")
    main(["demographics", "--input-dir", folder, "--output-dir", out])
    main(["time-series", "--input-dir", folder, "--output-dir", out, "--emb-technique", "fixed_time_interval", "--bin-length", "12"])
    main(["time-series", "--input-dir", folder, "--output-dir", out, "--emb-technique", "gru"])
    main(["time-series", "--input-dir", folder, "--output-dir", out, "--emb-technique", "moment"])
    main(["notes", "--input-dir", folder, "--output-dir", out])
    block = sinks.read_matrix(spark, f"{out}/fixed_time_interval")
    assert block.columns[1:] == [f"{v}_{b}" for v in VITAL_SIGNS for b in range(2)]
    assert block.count() == clinic.STAYS
    tensor = spark.read.parquet(f"{out}/gru_input").first()["tensor"]
    assert len(tensor[0]) == 2 * len(VITAL_SIGNS) + 1
    assert spark.read.parquet(f"{out}/note_texts").count() == clinic.STAYS

    vectors = spark.range(30000, 30000 + clinic.STAYS).select(F.col("id").alias("stay_id"), F.rand(1).alias("e0"), F.rand(2).alias("e1"))
    sinks.write_matrix(vectors, f"{out}/img", ["e0", "e1"])
    tabular = read(spark, world, "training", "tabular")
    blocks = {
        "tabular": features.column_block(sinks.read_matrix(spark, f"{out}/tabular")),
        "time_series": features.column_block(experiment.scaled_block(block)),
        "image": features.vector_block(spark.read.parquet(f"{out}/img/data"), "data", 2, "img_"),
        "text": features.column_block(vectors),
    }
    fused = features.fuse(blocks, tabular.select("stay_id", "los_binary"))
    search = logistic_search(20, strengths=[1.0], penalties=["l2"], iterations=[10])
    store = ModelStore(spark, f"{tmp_path}/models")
    both = ["Baseline", "Baseline+Image+Text"]
    scores = experiment.predictions(fused, "los_binary", "fixed+img+txt", mixes=both, search=search, store=store)
    shares = experiment.contributions(fused, store, both).groupBy("mix").agg(F.count("*").alias("n"), F.sum("contribution").alias("all"))
    assert rows(shares, "mix", "n", "all") == [("Baseline", 2, pytest.approx(1, abs=1e-5)), ("Baseline+Image+Text", 4, pytest.approx(1, abs=1e-5))]
    assert scores.select("mix").distinct().count() == 2
    scores.write.parquet(f"{tmp_path}/scores")
    main(["evaluate", "--results", f"{tmp_path}/scores", "--tabular-dir", folder, "--output-dir", f"{tmp_path}/eval", "--n-bootstraps", "20"])
    table = spark.read.option("header", True).csv(f"{tmp_path}/eval/performance")
    assert table.columns == ["models", "mix", "AUROC", "Accuracy", "TPR", "FPR", "AUPRC"] and table.count() == 2


def test_questions_through_the_command_line(spark, world, tmp_path):
    main(["qa", "--input-dir", f"{world[0]}/training", "--output-dir", str(tmp_path), "--split", "all"])
    main(["prompts", "--records", f"{tmp_path}/qa_dataset", "--output-dir", str(tmp_path), "--outcome", "los_binary"])
    prompts = spark.read.json(f"{tmp_path}/prompts")
    assert prompts.count() == clinic.STAYS
    assert prompts.where("prompt LIKE '%exceed three days?%'").count() == clinic.STAYS


def test_ingested_sources_give_the_same_master_tables(spark, world, tmp_path):
    output = str(tmp_path / "master")
    main(["master", *world[2], "--output-dir", output, "--ingest-path", str(tmp_path / "parquet")])
    for name in ("admissions", "chartevents", "dsnotes", "radnotes", "cxr_metadata", "diagnoses_icd", "list_ids"):
        a, b = spark.read.parquet(f"{output}/{name}.parquet"), read(spark, world, "master", name)
        assert a.count() == b.count() and a.columns == b.columns
    assert spark.read.parquet(f"{output}/diagnoses_icd.parquet").first()["icd_code"] == "0071"
    assert dict(spark.read.parquet(f"{output}/admissions.parquet").dtypes)["edregtime"] == "timestamp_ntz"


def test_types_are_found_over_all_rows(spark, tmp_path):
    lines = ["a,b,c,d,e,f,g,itemid", *[f"{i},{i}.5,0{i},2150-01-0{i % 9 + 1},,x{i},{i},{i}" for i in range(400)]]
    lines += ['-7,1e3,"0,1",2150-01-01 10:11:12,,"say ""a""",2.0,oops']
    path = tmp_path / "t.csv"
    path.write_text("\n".join(lines) + "\n")
    found = ingest.ingest_csv(spark, str(path), str(tmp_path / "t.parquet"))
    assert found.types == {"a": "bigint", "b": "double", "c": "string", "d": "timestamp_ntz", "e": "string", "f": "string", "g": "double", "itemid": "bigint"}
    last = found.data.where("a = -7").first()
    assert (last["b"], last["c"], last["f"], last["g"], last["itemid"]) == (1000.0, "0,1", 'say "a"', 2.0, None)
    assert found.wrote and not ingest.ingest_csv(spark, str(path), str(tmp_path / "t.parquet")).wrote


def test_a_broken_run_by_stay_goes_on_with_what_is_missing(spark, world, tmp_path, monkeypatch):
    """One table breaks off in its second batch; the next run writes the groups that lack, and the store is whole."""
    folder, whole, part = f"{world[0]}/master", str(tmp_path / "whole"), str(tmp_path / "part")
    main(["stays", "--input-dir", folder, "--output-dir", whole, "--groups", "4", "--batch", "4"])
    calls, real = [], sinks.write_by_stay

    def breaks(df, path, groups):
        calls.append(path)
        if sum(p.endswith("/chartevents") for p in calls) == 2:
            raise InterruptedError
        real(df, path, groups)

    monkeypatch.setattr(sinks, "write_by_stay", breaks)
    with pytest.raises(InterruptedError):
        stays.export_stays(spark, folder, part, groups=4, batch=2)
    monkeypatch.setattr(sinks, "write_by_stay", real)
    done = stays.export_stays(spark, folder, part, groups=4, batch=2)
    assert done["chartevents"] == [2, 3] and [] in done.values() and [0, 1, 2, 3] in done.values()
    for name in done:
        a, b = (spark.read.parquet(f"{place}/{name}") for place in (whole, part))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() > 0, name
    assert stays.export_stays(spark, folder, part, groups=4, batch=2) == dict.fromkeys(done, [])
    one = read(spark, world, "master", "icustays").first()
    tables = stays.read_stay(spark, whole, one["stay_id"], groups=4)
    assert tables["icustays"].count() == 1 and tables["patients"].first()["subject_id"] == one["subject_id"]
    assert {r["stay_id"] for r in tables["chartevents"].select("stay_id").collect()} <= {one["stay_id"]}
