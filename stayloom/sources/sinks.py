"""Writers, and their readers where the stored form is special."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.sources.folders import is_written


def write_table(
    df: DataFrame, path: str, overwrite: bool = False, sort_by: Sequence[str] = (), ascending: bool = True
) -> bool:
    """Write parquet unless a finished copy exists; returns whether it wrote.

    With `sort_by`, files hold consecutive key ranges and rows are sorted within them: reading
    the files in name order gives the whole table in order, without one task sorting it all.
    """
    if not overwrite and is_written(df.sparkSession, path):
        return False
    if sort_by:
        df = sorted_by(df, sort_by, ascending)
    df.write.mode("overwrite").parquet(path)
    return True


def sorted_by(df: DataFrame, columns: Sequence[str], ascending: bool = True) -> DataFrame:
    """Rows in consecutive ranges of `columns`, sorted within each."""
    keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in columns]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def written(
    df: DataFrame, path: str, overwrite: bool = False, sort_by: Sequence[str] = (), ascending: bool = True
) -> DataFrame:
    """Write `df` (or keep the finished copy) and read it back: later joins know its real size."""
    write_table(df, path, overwrite, sort_by, ascending)
    return df.sparkSession.read.parquet(path)


def write_by_stay(df: DataFrame, path: str, groups: int = 256) -> None:
    """Write a stay table in `groups` folders by stay; writing some stays' groups anew replaces only those."""
    (
        df.withColumn("stay_group", F.pmod("stay_id", F.lit(groups)))
        .repartition("stay_group")  # else every task writes a file into each folder
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("stay_group")
        .parquet(path)
    )


def finished_groups(spark: SparkSession, path: str) -> set[int]:
    """The stay groups that were written to the end, at most as many numbers as there are groups."""
    place = f"{path}/_finished"
    if not is_written(spark, place):
        return set()
    return {r["stay_group"] for r in spark.read.parquet(place).select("stay_group").distinct().collect()}


def write_missing_groups(
    stays: DataFrame, make: Callable[[DataFrame], DataFrame], path: str, groups: int = 256, batch: int = 32
) -> list[int]:
    """Make and write the stay groups that are not finished, `batch` groups at a time; returns their numbers.

    `make` gets the stays of a batch and returns rows with their stay_id, so that only what is missing is
    computed.  A batch counts as finished when its rows and after them its numbers are written: a run
    that ends before begins again with that batch and replaces what it left.  Groups without rows count too.
    """
    spark = stays.sparkSession
    missing = sorted(set(range(groups)) - finished_groups(spark, path))
    own = F.pmod("stay_id", F.lit(groups)).cast("int")
    for first in range(0, len(missing), batch):
        turn = missing[first : first + batch]
        write_by_stay(make(stays.where(own.isin(turn))), path, groups)
        done = spark.createDataFrame([(g,) for g in turn], "stay_group int").coalesce(1)
        done.write.mode("append").parquet(f"{path}/_finished")
    return missing


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_written_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What `write_csv` wrote, with the types of `schema`."""
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True).schema(schema).csv(path)


def write_matrix(df: DataFrame, path: str, columns: Sequence[str], key: str = "stay_id") -> None:
    """Store feature columns as one array per key; the column names are kept beside the values."""
    df.select(
        key,
        F.array(*[F.col(f"`{c}`").cast("double") for c in columns]).alias("data"),
    ).write.mode("overwrite").parquet(f"{path}/data")
    names = [(i, c) for i, c in enumerate(columns)]
    df.sparkSession.createDataFrame(names, "position int, name string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/columns")


def read_matrix(spark: SparkSession, path: str, key: str = "stay_id") -> DataFrame:
    """The stored features with one column each again."""
    names = spark.read.parquet(f"{path}/columns").orderBy("position").collect()
    data = spark.read.parquet(f"{path}/data")
    return data.select(key, *[F.get("data", F.lit(r["position"])).alias(r["name"]) for r in names])


def write_records(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
