"""Images of a stay: index with paths and finding labels, views, pooling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.config import FINDINGS, FRONTAL_VIEWS
from stayloom.functions.values import prefixed, quoted
from stayloom.operators.joins import known, restrict
from stayloom.operators.linkage import IMAGE
from stayloom.operators.windows import in_window

STUDY = ["subject_id", "study_id"]


def images_of_stays(metadata: DataFrame, image_link: DataFrame) -> DataFrame:
    """Metadata rows with the stays they are linked to; each (stay, image) pair counts once.

    Of the metadata only what a written link names is shuffled.
    """
    linked = image_link.dropna(subset=["stay_id", "study_id"]).where(known("dicom_id"))
    pairs = linked.select("stay_id", *IMAGE)
    joined = restrict(metadata, linked, IMAGE).join(pairs.distinct(), IMAGE)
    return joined.select("stay_id", *[quoted(c) for c in metadata.columns])


def images_in_windows(metadata: DataFrame, image_link: DataFrame, windows: DataFrame) -> DataFrame:
    """Images of stays taken inside the window of their stay."""
    bounds = restrict(windows.select("stay_id", "start_time", "end_time"), image_link.where(known("dicom_id")), ["stay_id"])
    return in_window(
        images_of_stays(metadata, image_link), bounds, ["stay_id"], "StudyDatetime", ["stay_id", *metadata.columns]
    )


def image_index(
    metadata: DataFrame,
    image_link: DataFrame,
    windows: DataFrame,
    image_paths: DataFrame,
    report_paths: DataFrame,
    labelers: dict[str, DataFrame],
    findings: Sequence[str] = FINDINGS,
) -> DataFrame:
    """Images inside the window of their stay with paths and the findings of each labeler.

    The labelers share their column names, so each one's findings carry its name as prefix.  Paths and
    findings are restricted to the linked images and studies before they are joined.
    """
    images = images_in_windows(metadata, image_link, windows)
    linked = image_link.where(known("dicom_id"))

    def attach(index: DataFrame, added: DataFrame, on: Sequence[str]) -> DataFrame:
        return index.join(restrict(added, linked, on), list(on), "left")

    index = attach(images, image_paths.select(*IMAGE, F.col("path").alias("image_path")), IMAGE)
    index = attach(index, report_paths.select(*STUDY, F.col("path").alias("text_path")), STUDY)
    added = ["image_path", "text_path"]
    for name, labels in labelers.items():
        named = prefixed(labels.select(*STUDY, *[quoted(f) for f in findings]), f"{name}_", findings)
        index = attach(index, named, STUDY)
        added += [f"{name}_{f}" for f in findings]
    return index.select(*[quoted(c) for c in (*images.columns, *added)])


def frontal(images: DataFrame, views: Sequence[str] = FRONTAL_VIEWS) -> DataFrame:
    """Images taken from an accepted direction."""
    return images.where(F.col("ViewPosition").isin(list(views)))


def latest_image(images: DataFrame, key: str = "stay_id", at: str = "StudyDatetime") -> DataFrame:
    """The last image of each stay, by time and then image id."""
    others = [c for c in images.columns if c != key]
    row = F.struct(at, "dicom_id", *[quoted(c) for c in others if c not in (at, "dicom_id")])
    last = images.groupBy(key).agg(F.max(row).alias("last"))
    return last.select(key, *[F.col("last")[c].alias(c) for c in others])


def images_per_stay(images: DataFrame, key: str = "stay_id") -> DataFrame:
    """Number of images of each stay that has any."""
    return images.groupBy(key).agg(F.count(F.lit(1)).alias("n_images"))


def image_count_stats(images: DataFrame, key: str = "stay_id") -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of the number of images per stay.

    Stays with the same number are counted first, so the quartiles see one row per number.
    """
    counts = images_per_stay(images, key).groupBy("n_images").agg(F.count(F.lit(1)).alias("stays"))
    n, x = F.col("stays"), F.col("n_images").cast("double")
    total, mean = F.sum(n), F.sum(n * x) / F.sum(n)
    spread = F.try_divide(F.sum(n * x * x) - F.sum(n) * mean * mean, F.sum(n) - 1)
    quartiles = F.percentile(F.col("n_images"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    return counts.agg(
        total.alias("count"),
        mean.alias("mean"),
        F.sqrt(F.greatest(spread, F.lit(0.0))).alias("std"),
        F.min(x).alias("min"),
        quartiles.alias("q"),
        F.max(x).alias("max"),
    ).select(
        "count", "mean", "std", "min",
        F.get("q", F.lit(0)).alias("p25"), F.get("q", F.lit(1)).alias("p50"),
        F.get("q", F.lit(2)).alias("p75"), "max",
    )


def mean_pool(vectors: DataFrame, key: str = "stay_id", vector: str = "embedding") -> DataFrame:
    """Element-wise mean of the vectors of each key.

    Vectors are summed on the map side, so a key with very many vectors sends one sum per task.
    """
    return vectors.where(F.col(vector).isNotNull()).groupBy(key).agg(
        Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>"))).alias("mean")
    ).select(key, vector_to_array("mean").alias(vector))
