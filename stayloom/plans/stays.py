"""The master tables by stay: every row with the stay it belongs to, stored by stay group, resumable."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayloom.functions.values import quoted
from stayloom.operators.linkage import ADMISSION, STAY, split_links
from stayloom.session import tune
from stayloom.sources.folders import is_written, table_paths
from stayloom.sources.sinks import write_missing_groups

#: Linked tables by the column that tells them; the first one a table has counts.
LINKED = [("note_id", ["discharge", "radiology"]), ("dicom_id", ["image"]), ("study_id", ["image"])]


def rows_of_stays(df: DataFrame, stays: DataFrame, links: Mapping[str, DataFrame]) -> DataFrame:
    """`df` with stay_id first: by stay, by link (notes, images), by admission or by subject.

    A row of an admission or subject with several stays belongs to each of them.
    """
    rest = [quoted(c) for c in df.columns if c != "stay_id"]
    if "stay_id" in df.columns:
        keys = [c for c in STAY if c in df.columns]
        return df.join(stays.select(*STAY).distinct(), keys, "left_semi").select("stay_id", *rest)
    for column, names in LINKED:
        if column in df.columns:
            pairs = None
            for name in names:
                on = [c for c in links[name].columns if c in df.columns]
                own = links[name].join(stays.select(*STAY).distinct(), STAY, "left_semi").select("stay_id", *on)
                pairs = own if pairs is None else pairs.unionByName(own, allowMissingColumns=True)
            on = [c for c in pairs.columns if c != "stay_id"]
            return df.join(pairs.dropna().distinct(), on).select("stay_id", *rest)
    on = ADMISSION if "hadm_id" in df.columns else ["subject_id"]
    return df.join(stays.select("stay_id", *on).distinct(), on).select("stay_id", *rest)


def export_stays(
    spark: SparkSession, master: str, output: str, groups: int = 256, batch: int = 32
) -> dict[str, list[int]]:
    """Write each master table by stay group; returns which groups were missing and written now."""
    tune(spark)
    if not is_written(spark, f"{master}/list_ids.parquet"):
        raise FileNotFoundError(f"expected tables not found in {master}: list_ids")
    links = split_links(spark.read.parquet(f"{master}/list_ids.parquet"))
    done = {}
    for name, path in table_paths(spark, master).items():
        if name in ("list_ids", "cxr_study_datetime"):
            continue
        table = spark.read.parquet(path)
        if "subject_id" not in table.columns:
            continue
        done[name] = write_missing_groups(
            links["stay"].distinct(), lambda stays, table=table: rows_of_stays(table, stays, links), f"{output}/{name}",
            groups, batch,
        )
    return done


def read_stay(spark: SparkSession, store: str, stay_id: int, groups: int = 256) -> dict[str, DataFrame]:
    """All tables of one stay; only its group is read."""
    tables = {}
    for name in _folders(spark, store):
        rows = spark.read.parquet(f"{store}/{name}")
        tables[name] = rows.where((F.col("stay_group") == stay_id % groups) & (F.col("stay_id") == stay_id)).drop("stay_group")
    return tables


def _folders(spark: SparkSession, store: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(store)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return sorted(status.getPath().getName() for status in found if status.isDirectory())
