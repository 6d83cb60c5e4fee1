"""Value expressions: regrouping, clipping, banding, paths and numbers as text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.config import AGE_CUTOFFS, RACE_GROUPS, RACE_OTHER


def quoted(name: str) -> Column:
    """Column by its literal name, whatever characters it holds."""
    return F.col(f"`{name}`")


def regroup(column: str, groups: Sequence[str] = RACE_GROUPS, other: str = RACE_OTHER) -> Column:
    """First group whose name occurs in the value; `other` when none does or the value is NULL."""
    value = quoted(column)
    found = [F.when(value.contains(g), F.lit(g)) for g in groups]
    return F.coalesce(*found, F.lit(other))


def clip(column: str, bounds: Sequence[float]) -> Column:
    """NULL outside the outlier bounds, the nearest valid value outside the valid bounds."""
    outlier_low, valid_low, valid_high, outlier_high = bounds
    value = F.nanvl(quoted(column).cast("double"), F.lit(None).cast("double"))
    return (
        F.when((value < outlier_low) | (value > outlier_high), F.lit(None))
        .when(value < valid_low, F.lit(float(valid_low)))
        .when(value > valid_high, F.lit(float(valid_high)))
        .otherwise(value)
    )


def clip_outliers(df: DataFrame, bounds: Mapping[str, Sequence[float]]) -> DataFrame:
    """Apply `clip` to every bounded column that `df` has."""
    return df.withColumns({c: clip(c, b) for c, b in bounds.items() if c in df.columns})


def band(column: str, cutoffs: Sequence[int] = AGE_CUTOFFS, name: str = "Age") -> Column:
    """Name of the band between `cutoffs`; upper ends belong to the lower band."""
    value = quoted(column)
    low, high = cutoffs
    return (
        F.when(value <= low, F.lit(f"{name}<={low}"))
        .when(value <= high, F.lit(f"{low}<{name}<={high}"))
        .when(value > high, F.lit(f"{name}>{high}"))
    )


def at_least(probability: str | Column, threshold: float = 0.5) -> Column:
    """1 from the threshold on, else 0."""
    probability = quoted(probability) if isinstance(probability, str) else probability
    return (probability >= threshold).cast("int")


def above(probability: str | Column, threshold: float = 0.5) -> Column:
    """1 above the threshold, else 0."""
    probability = quoted(probability) if isinstance(probability, str) else probability
    return (probability > threshold).cast("int")


def prefixed(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    """Put `prefix` before the names of `columns`."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


def image_path(subject: str, study: str, image: str, extension: str = ".jpg") -> Column:
    """Path of an image in the public folder layout."""
    person = quoted(subject).cast("bigint").cast("string")
    return F.concat(
        F.lit("files/p"), F.substring(person, 1, 2), F.lit("/p"), person,
        F.lit("/s"), quoted(study).cast("bigint").cast("string"),
        F.lit("/"), quoted(image), F.lit(extension),
    )


def file_name(path: str | Column) -> Column:
    """Last component of a path."""
    path = quoted(path) if isinstance(path, str) else path
    return F.substring_index(path, "/", -1)


def with_extension(path: str | Column, extension: str) -> Column:
    """Path with the extension of its last component replaced."""
    path = quoted(path) if isinstance(path, str) else path
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(extension))


def number_text(value: str | Column) -> Column:
    """A double in plain decimal digits, with at least one digit after the point."""
    value = (quoted(value) if isinstance(value, str) else value).cast("double")
    size = F.abs(value)
    plain = F.regexp_replace(value.cast("decimal(38,12)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(
        value.isNotNull() & ((size == 0) | ((size >= 1e-3) & (size < 1e7))), value.cast("string")
    ).otherwise(plain)
