"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of input tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayloom.driver import QUERIES  # noqa: E402

HEADLINE = [
    "link_interval_join", "link_summary", "cohort_semi_join", "dictionary_join", "header_detail_join",
    "linked_rows_distinct", "image_index", "stay_windows", "windowed_events", "vitals_pivot", "frac_hours",
    "modality_presence", "cohort_select", "outcomes", "readmission_window", "export_included", "export_sorted",
    "time_bin_mean", "ffill_bfill", "global_median", "ts_fixed_interval", "ts_tensor", "vector_mean_pool",
    "feature_fusion", "one_hot", "detail_fields", "notes_sep_join", "patient_profile", "prompt_text",
    "auroc", "auprc", "bootstrap_ci", "fairness_report", "modality_contribution", "table_fingerprint",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("hash_split", "dictionary_join", "stay_base"):  # warm up the JVM
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
