"""Command line: python -m stayloom <command> …"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from stayloom.config import AGE_CUTOFFS, MODALITY_MIXES, TABULAR_VARIABLES, VITAL_SIGNS, TrainingConfig
from stayloom.operators import features, metrics, profiles
from stayloom.operators.models import ModelStore
from stayloom.plans import experiment, master, stays, training
from stayloom.session import build_session, intermediate
from stayloom.sources.folders import require
from stayloom.sources.sinks import read_matrix, read_records, write_csv, write_matrix, write_records


def run_master(spark, a) -> None:
    sources = master.register_sources(
        spark, a.hosp_path, a.icu_path, a.cxr_path, a.cxr_jpg_path, a.note_path, a.ingest_path
    )
    done = master.export_master(
        spark, sources, a.output_dir, a.overwrite, a.rebuild_list_ids, a.debug_limit,
        a.list_ids_path, a.cxr_datetime_path,
    )
    for name, wrote in done.items():
        print(f"{name}: {'written' if wrote else 'kept'}")


def run_stays(spark, a) -> None:
    for name, groups in stays.export_stays(spark, a.input_dir, a.output_dir, a.groups, a.batch).items():
        print(f"{name}: {len(groups)} of {a.groups} groups written")


def run_training(spark, a) -> None:
    config = TrainingConfig(
        a.age_lower, a.age_upper, a.los_lower, a.drop_missing_ts, a.drop_missing_img, a.drop_missing_text,
        a.start_diff, a.end_diff, a.tabular_variables, a.vital_signs_variables,
        los_range=a.los_range, readmission_range=a.readmission_range, debug_limit=a.debug_limit,
    )
    audit = training.export_training(
        spark, a.input_dir, a.output_dir, config, not a.unsorted, not a.descending
    )
    audit.show(truncate=False)


def run_demographics(spark, a) -> None:
    tabular = require(spark, a.input_dir, ["tabular"])["tabular"]
    block = experiment.demographic_block(tabular, a.numerical_variables, a.categorical_variables)
    write_matrix(block, f"{a.output_dir}/tabular", [c for c in block.columns if c != "stay_id"])


def run_time_series(spark, a) -> None:
    tables = require(spark, a.input_dir, ["tabular", "time_series"])
    variables = [v for v in VITAL_SIGNS if v in tables["time_series"].columns]
    if a.emb_technique == "fixed_time_interval":
        block = experiment.fixed_interval_block(
            tables["time_series"], tables["tabular"].select("stay_id"), a.total_length, a.bin_length,
            a.imputation, variables,
        )
        names = [c for c in block.columns if c != "stay_id"]
        write_matrix(block, f"{a.output_dir}/fixed_time_interval", names)
        return
    found = experiment.sequences(
        tables["time_series"], a.total_length, a.imputation, variables, scaled=a.emb_technique == "gru"
    )
    found.data.write.mode("overwrite").parquet(f"{a.output_dir}/{a.emb_technique}_input")


def run_notes(spark, a) -> None:
    radiology = require(spark, a.input_dir, ["notes_radiology"])["notes_radiology"]
    experiment.note_texts(radiology, a.numbered).write.mode("overwrite").parquet(f"{a.output_dir}/note_texts")


def fused_features(spark, a) -> tuple[features.FusedFeatures, str]:
    """The fused blocks named on the command line, with the outcome, and the name of their models."""
    tabular = require(spark, a.input_dir, ["tabular"])["tabular"]
    path = a.embedding_path
    series = read_matrix(spark, f"{path}/{a.time_series_model}")
    blocks = {
        "tabular": features.column_block(read_matrix(spark, f"{path}/tabular")),
        "time_series": features.column_block(
            experiment.scaled_block(series) if a.time_series_model == "fixed_time_interval" else series
        ),
        "image": features.column_block(read_matrix(spark, f"{path}/{a.image_model}")),
        "text": features.column_block(read_matrix(spark, f"{path}/{a.text_model}")),
    }
    name = f"{a.time_series_model}+{a.image_model}+{a.text_model}"
    return features.fuse(blocks, tabular.select("stay_id", a.outcome)), name


def model_store(spark, a, name: str) -> ModelStore:
    return ModelStore(spark, f"{a.model_path or a.output_dir}/{a.outcome}/{name.replace('+', '_')}_models")


def run_classify(spark, a) -> None:
    fused, name = fused_features(spark, a)
    scores = experiment.predictions(
        fused, a.outcome, name, a.classification_model, a.mixes, store=model_store(spark, a, name)
    )
    scores.write.mode("overwrite").parquet(f"{a.output_dir}/{a.outcome}/{name.replace('+', '_')}_results")


def run_contribution(spark, a) -> None:
    fused, name = fused_features(spark, a)
    shares = experiment.contributions(fused, model_store(spark, a, name), a.mixes)
    write_csv(shares, f"{a.output_dir}/{a.outcome}/{name.replace('+', '_')}_contribution")


def run_evaluate(spark, a) -> None:
    scores = spark.read.parquet(*a.results)
    write_csv(experiment.performance(scores, a.n_bootstraps, a.alpha), f"{a.output_dir}/performance")
    baseline = scores.where("mix = 'Baseline'").withColumnRenamed("models", "model")
    metrics.best_model(baseline).show(truncate=False)
    if a.tabular_dir:
        tabular = require(spark, a.tabular_dir, ["tabular"])["tabular"]
        for mix in [r["mix"] for r in scores.select("mix").distinct().collect()]:
            report = experiment.fairness(scores.where(F.col("mix") == mix), tabular, cutoffs=a.cutoffs)
            write_csv(report, f"{a.output_dir}/fairness/{mix}")


def run_qa(spark, a) -> None:
    tables = require(spark, a.input_dir, ["tabular", "time_series", "cxr_index", "notes_radiology"])
    records = experiment.qa_dataset(
        tables["tabular"], tables["time_series"], tables["cxr_index"], tables["notes_radiology"],
        None if a.split == "all" else a.split,
    )
    write_records(records, f"{a.output_dir}/qa_dataset")


def run_prompts(spark, a) -> None:
    records = read_records(spark, a.records, profiles.RECORD_SCHEMA)
    write_records(profiles.prompts(records, a.outcome, a.style, a.system), f"{a.output_dir}/prompts")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="stayloom")
    commands = top.add_subparsers(required=True)

    def command(name: str, run, text: str, output: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.set_defaults(run=run)
        if output:
            sub.add_argument("--output-dir", required=True)
        return sub

    c = command("master", run_master, "link stays, images and notes; write the master tables")
    for folder in ("hosp", "icu", "cxr", "cxr-jpg", "note"):
        c.add_argument(f"--{folder}-path", required=True)
    c.add_argument("--ingest-path")
    c.add_argument("--list-ids-path")
    c.add_argument("--cxr-datetime-path")
    c.add_argument("--rebuild-list-ids", action="store_true")
    c.add_argument("--overwrite", action="store_true")
    c.add_argument("--debug-limit", type=int)

    c = command("stays", run_stays, "the master tables by stay, in resumable groups")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--groups", type=int, default=256)
    c.add_argument("--batch", type=int, default=32)

    c = command("training", run_training, "window, pivot, label and select; write the training tables")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--age-lower", type=int, default=0)
    c.add_argument("--age-upper", type=int, default=150)
    c.add_argument("--los-lower", type=float, default=0)
    for modality in ("ts", "img", "text"):
        c.add_argument(f"--drop-missing-{modality}", action="store_true")
    c.add_argument("--start-diff", type=int)
    c.add_argument("--end-diff", type=int)
    c.add_argument("--tabular-variables", nargs="+", default=TABULAR_VARIABLES)
    c.add_argument("--vital-signs-variables", nargs="+", default=VITAL_SIGNS)
    c.add_argument("--los-range", type=float, default=3)
    c.add_argument("--readmission-range", type=int, default=30)
    c.add_argument("--unsorted", action="store_true")
    c.add_argument("--descending", action="store_true")
    c.add_argument("--debug-limit", type=int)

    c = command("demographics", run_demographics, "demographic features")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--numerical-variables", nargs="+", default=["age"])
    c.add_argument(
        "--categorical-variables", nargs="+",
        default=["gender", "race", "marital_status", "language", "insurance"],
    )

    c = command("time-series", run_time_series, "time-series features or model inputs")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--emb-technique", choices=["fixed_time_interval", "gru", "moment"], default="gru")
    c.add_argument("--total-length", type=int, default=24)
    c.add_argument("--bin-length", type=int, default=1)
    c.add_argument("--imputation", choices=["forward", "mean", "median", "zero"], default="forward")

    c = command("notes", run_notes, "one text per stay for a text encoder")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--numbered", action="store_true")

    def blocks(c: argparse.ArgumentParser) -> None:
        c.add_argument("--input-dir", required=True)
        c.add_argument("--embedding-path", required=True)
        c.add_argument("--time-series-model", default="fixed_time_interval")
        c.add_argument("--image-model", default="cxr_foundation")
        c.add_argument("--text-model", default="radbert")
        c.add_argument("--outcome", default="hospital_expire_flag")
        c.add_argument("--model-path")
        c.add_argument("--mixes", nargs="+", choices=list(MODALITY_MIXES), default=list(MODALITY_MIXES))

    c = command("classify", run_classify, "fuse feature blocks, train, keep the models and score")
    blocks(c)
    c.add_argument("--classification-model", choices=["LR", "GBT"], default="LR")

    c = command("contribution", run_contribution, "contribution of each modality under kept linear models")
    blocks(c)

    c = command("evaluate", run_evaluate, "performance, best baseline and fairness tables")
    c.add_argument("--results", nargs="+", required=True)
    c.add_argument("--tabular-dir")
    c.add_argument("--n-bootstraps", type=int, default=1000)
    c.add_argument("--alpha", type=float, default=0.95)
    c.add_argument("--cutoffs", type=int, nargs=2, default=AGE_CUTOFFS)

    c = command("qa", run_qa, "question records")
    c.add_argument("--input-dir", required=True)
    c.add_argument("--split", choices=["train", "val", "test", "all"], default="test")

    c = command("prompts", run_prompts, "prompt texts of question records")
    c.add_argument("--records", required=True)
    c.add_argument("--outcome", default="hospital_expire_flag")
    c.add_argument("--style", choices=sorted(profiles.PROMPT_STYLES), default="plain")
    c.add_argument("--system", help=f"{', '.join(sorted(profiles.SYSTEM_TEXTS))}, or a text of your own")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    with intermediate(spark):
        args.run(spark, args)


if __name__ == "__main__":
    main()
