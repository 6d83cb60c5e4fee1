"""Folders of source tables: one table per `.parquet` or `.csv.gz` entry, named after it."""

from __future__ import annotations

import csv
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stayloom.functions.times import coerce_datetimes
from stayloom.sources.schemas import MULTI_LINE_TABLES, csv_schema

PARQUET, CSV = ".parquet", ".csv.gz"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whichever file system the path names."""
    system, hadoop_path = _file_system(spark, str(path))
    return system.exists(hadoop_path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to the end; a folder left by a failed job does not count."""
    system, hadoop_path = _file_system(spark, str(path))
    if not system.exists(hadoop_path):
        return False
    return not system.getFileStatus(hadoop_path).isDirectory() or exists(spark, f"{path}/_SUCCESS")


def table_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table name → path for every readable entry of a folder; other entries are skipped."""
    system, hadoop_path = _file_system(spark, str(folder))
    found: dict[str, str] = {}
    for name in sorted(status.getPath().getName() for status in system.listStatus(hadoop_path)):
        for suffix in (CSV, PARQUET):
            if name.endswith(suffix):
                found[name.removesuffix(suffix)] = f"{str(folder).rstrip('/')}/{name}"
    return found


_CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def header_of(spark: SparkSession, path: str) -> list[str]:
    return next(csv.reader([spark.read.text(path).first()["value"]]))


def read_csv_texts(spark: SparkSession, path: str, header: list[str], multi_line: bool = False) -> DataFrame:
    """A CSV file with header, quote and escape pinned to `"`, every column as text."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return _spread(spark.read.options(**_CSV_OPTIONS, multiLine=multi_line).csv(path, schema=schema), path)


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file with header, quote and escape pinned to `"` and declared column types.

    Columns without a declared type are text; `ingest` finds their types.
    """
    schema = csv_schema(header_of(spark, path))
    return _spread(spark.read.options(**_CSV_OPTIONS, multiLine=multi_line).csv(path, schema=schema), path)


def _spread(df: DataFrame, path: str) -> DataFrame:
    """A gzip file is one task whatever its size, so its rows are spread before further work."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if path.endswith(".gz") else df


def read_table(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    if path.endswith(CSV):
        return read_csv(spark, path, multi_line=name in MULTI_LINE_TABLES)
    return spark.read.parquet(path)


def scan_folder(spark: SparkSession, folder: str, cast_datetimes: bool = False) -> dict[str, DataFrame]:
    """Every table of a folder, lazily, and as a temporary view of the same name."""
    tables = {}
    for name, path in table_paths(spark, folder).items():
        df = read_table(spark, path, name)
        tables[name] = coerce_datetimes(df) if cast_datetimes else df
        tables[name].createOrReplaceTempView(f"`{name}`")
    return tables


def require(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The named tables of a folder written by an earlier step; a missing one is an error."""
    missing = [n for n in names if not is_written(spark, f"{folder}/{n}.parquet")]
    if missing:
        raise FileNotFoundError(f"expected tables not found in {folder}: {', '.join(missing)}")
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
