"""Run registered queries and their SQL side by side and compare columns, types and rows.

usage: python tools/check_queries.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayloom.driver import ORACLES, QUERIES  # noqa: E402
from stayloom.driver.views import TABLES  # noqa: E402


def normal(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "item"):
        return normal(value.item())
    return value


def rows_of(table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted((tuple(normal(v) for v in row) for row in zip(*columns)), key=repr)


def compare(name: str, spark: SparkSession, con, folder: str) -> tuple[str, float]:
    start = time.time()
    got = QUERIES[name](spark, folder).toArrow()
    seconds = time.time() - start
    if name not in ORACLES:
        return f"rows only: {got.num_rows}", seconds
    want = con.sql(ORACLES[name]).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"COLUMNS differ: {sorted(got.column_names)} / {sorted(want.column_names)}", seconds
    notes = []
    for column in sorted(got.column_names):
        a, b = got.schema.field(column).type, want.schema.field(column).type
        if str(a).replace("large_", "") != str(b).replace("large_", ""):
            notes.append(f"{column}: {a}/{b}")
    if got.num_rows != want.num_rows:
        return f"ROWS differ: {got.num_rows} / {want.num_rows}", seconds
    a, b = rows_of(got), rows_of(want)
    if a != b:
        first = next((x, y) for x, y in zip(a, b) if x != y)
        wrong = sum(x != y for x, y in zip(a, b))
        return f"VALUES differ in {wrong}/{len(a)}: {str(first)[:1500]}", seconds
    return f"ok {got.num_rows} rows" + (f"  types {notes}" if notes else ""), seconds


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("ROWS_PER_SLICE"):
        spark.conf.set("spark.stayloom.rowsPerSlice", os.environ["ROWS_PER_SLICE"])
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    bad = 0
    for name in names:
        try:
            verdict, seconds = compare(name, spark, con, folder)
        except Exception as error:  # noqa: BLE001
            text = str(error)
            verdict, seconds = "FAILED " + type(error).__name__ + ": " + text[:1200], 0.0
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:26s} {seconds:6.2f}s  {verdict}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(main())
