"""CSV sources turned into typed parquet tables once.

A compressed CSV file is read by one task, so it is read a single time: its texts are written as parquet,
everything else works on that.  A column gets its declared type, or else the narrowest of
long, double, timestamp and text that all its values have.  Whole columns decide, not a sample.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayloom.functions.times import TIMESTAMP
from stayloom.functions.values import quoted
from stayloom.session import settle
from stayloom.sources.folders import CSV, header_of, is_written, read_csv_texts, table_paths
from stayloom.sources.schemas import COLUMN_TYPES, MULTI_LINE_TABLES

# What a text must look like to be of a type; a leading zero marks a code, which stays text.
LONG = r"^[-+]?(0|[1-9][0-9]{0,17})$"
DOUBLE = r"^[-+]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"
LATTICE = ["bigint", "double", TIMESTAMP]  # narrowest first


def _fits(value: Column, kind: str) -> Column:
    if kind == "bigint":
        return value.rlike(LONG)
    if kind == "double":
        return value.rlike(DOUBLE)
    return value.rlike(MOMENT) & value.try_cast(TIMESTAMP).isNotNull()


def column_types(texts: DataFrame) -> dict[str, str]:
    """The type of every column: declared, or found over all rows in one pass. Empty columns are text."""
    declared = {c: COLUMN_TYPES[c].simpleString() for c in texts.columns if c in COLUMN_TYPES}
    open_ = [c for c in texts.columns if c not in declared]
    if not open_:
        return declared
    counts = []
    for i, c in enumerate(open_):
        counts.append(F.count(quoted(c)).alias(f"n_{i}"))
        counts += [F.count(F.when(_fits(quoted(c), kind), 1)).alias(f"k_{i}_{j}") for j, kind in enumerate(LATTICE)]
    found = texts.agg(*counts).first()
    out = dict(declared)
    for i, c in enumerate(open_):
        fitting = [kind for j, kind in enumerate(LATTICE) if found[f"n_{i}"] and found[f"k_{i}_{j}"] == found[f"n_{i}"]]
        out[c] = fitting[0] if fitting else "string"
    return {c: out[c] for c in texts.columns}


def typed(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    """Texts cast to their types; a text that is not of a declared type becomes NULL."""
    return texts.select(*[quoted(c) if types[c] == "string" else quoted(c).try_cast(types[c]).alias(c) for c in texts.columns])


@dataclass
class Ingested:
    """A typed table and whether it was written now."""

    data: DataFrame
    types: dict[str, str]
    wrote: bool


def ingest_csv(spark: SparkSession, source: str, target: str, multi_line: bool = False, overwrite: bool = False) -> Ingested:
    """The typed parquet table of a CSV file; a finished one is kept."""
    if overwrite or not is_written(spark, target):
        texts = settle(read_csv_texts(spark, source, header_of(spark, source), multi_line))
        types = column_types(texts)
        typed(texts, types).write.mode("overwrite").parquet(target)
        wrote = True
    else:
        wrote = False
    data = spark.read.parquet(target)
    names = {T.LongType(): "bigint", T.DoubleType(): "double", T.StringType(): "string", T.TimestampNTZType(): TIMESTAMP}
    return Ingested(data, {f.name: names.get(f.dataType, f.dataType.simpleString()) for f in data.schema.fields}, wrote)


def ingest_folder(spark: SparkSession, folder: str, target: str, overwrite: bool = False) -> dict[str, DataFrame]:
    """Every table of a folder, the CSV ones by way of parquet tables in `target`."""
    tables = {}
    for name, path in table_paths(spark, folder).items():
        if path.endswith(CSV):
            found = ingest_csv(spark, path, f"{target}/{name}.parquet", name in MULTI_LINE_TABLES, overwrite)
            tables[name] = found.data
        else:
            tables[name] = spark.read.parquet(path)
        tables[name].createOrReplaceTempView(f"`{name}`")
    return tables
