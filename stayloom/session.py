"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution decides broadcasts from measured sizes and splits skewed join partitions,
# also where a split costs one more shuffle.  No query in this package forces a broadcast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "1.0",
    # Spark filters the large side of a join by the other side's keys before it is shuffled, where that side
    # is a written table or scan with a comparison on it; a filter is 8 MB, whatever the number of keys.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "4000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "67108864",
}
# For queries of many joins, whose plans hold several copies of each filter on the driver: a filter is 2 MB, and lets
# more rows pass from some millions of keys on.  Files are compressed: a million keys in a few MB are a broadcast of
# 64 MB, which the driver builds, so sizes of files count four times.  The thresholds are of sizes counted so too.
LEAN = {
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "40MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": "16777216",
}

_local_folder: str | None = None
_settled: list[str] = []


def tune(spark: SparkSession, lean: bool = False) -> SparkSession:
    """Apply the settings every plan in this package relies on; `lean` ones spare the driver."""
    for key, value in (SETTINGS | LEAN if lean else SETTINGS).items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "stayloom") -> SparkSession:
    """A session for the command line; everything else comes from the cluster's own settings."""
    return tune(SparkSession.builder.appName(app).getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    A session of one process (master local or local[n]) that names none gets a folder of its own,
    which goes when the process ends; every other session must name one that all executors share.
    """
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="stayloom-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def settle(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table.

    Used where several consumers must see one result without computing it again, and where lost
    executors should not send a job back to the sources.  Spark knows the size of the written
    table when it plans the joins that follow, and reads only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    _settled.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def settled_tables() -> list[str]:
    """The tables settled so far in this process, in order."""
    return list(_settled)


def drop_settled(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete settled tables that nothing reads any more."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in _settled:
            _settled.remove(path)


@contextmanager
def intermediate(spark: SparkSession) -> Iterator[None]:
    """Delete the tables settled inside when the work that needed them has ended, well or not."""
    before = len(_settled)
    try:
        yield
    finally:
        drop_settled(spark, _settled[before:])
