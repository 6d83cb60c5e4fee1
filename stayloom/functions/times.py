"""Time expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.config import DATETIME_WORDS

TIMESTAMP = "timestamp_ntz"


def coerce_datetimes(df: DataFrame, words: Sequence[str] = DATETIME_WORDS) -> DataFrame:
    """Cast every column whose name holds one of `words` to a timestamp; bad values become NULL."""
    return df.select(
        *[
            F.col(f"`{name}`").try_cast(TIMESTAMP).alias(name)
            if any(word in name.lower() for word in words)
            else F.col(f"`{name}`")
            for name in df.columns
        ]
    )


def packed_datetime(date: str | Column, time: str | Column) -> Column:
    """Timestamp from an integer YYYYMMDD and a number HHMMSS.fff; the fraction is dropped."""
    date, time = (F.col(c) if isinstance(c, str) else c for c in (date, time))
    day = date.cast("int")
    clock = F.floor(F.round(time.cast("double"), 3)).cast("int")

    def digits(number: Column, skip: int) -> Column:
        return F.floor(number / F.lit(10**skip)).cast("int") % 100

    return F.make_timestamp_ntz(
        F.floor(day / F.lit(10000)).cast("int"), digits(day, 2), digits(day, 0),
        digits(clock, 4), digits(clock, 2), digits(clock, 0),
    )


def hours(count: int | Column) -> Column:
    count = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(hours=count.cast("int"))


def days(count: int | Column) -> Column:
    count = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(days=count.cast("int"))


def epoch_seconds(moment: str | Column) -> Column:
    """Whole seconds since 1970; fractions are cut off, so differences count second boundaries."""
    moment = F.col(moment) if isinstance(moment, str) else moment
    return F.unix_seconds(moment.cast("timestamp"))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Fractional hours from `start` to `end`, counted in second boundaries."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(3600.0)


def earliest(*moments: str) -> Column:
    """Smallest of the non-null moments of a row."""
    return F.least(*moments)


def window_start(start_diff: int | None) -> Column:
    """Start of the observation window: intime plus a signed offset, not before earliest_intime."""
    if start_diff is None:
        return F.col("earliest_intime")
    return F.greatest(F.col("intime") + hours(start_diff), F.col("earliest_intime"))


def window_end(end_diff: int | None) -> Column:
    """End of the observation window: intime plus an offset, not after outtime."""
    if end_diff is None:
        return F.col("outtime")
    return F.least(F.col("intime") + hours(end_diff), F.col("outtime"))


def inside(moment: str, start: str = "start_time", end: str = "end_time") -> Column:
    """Strictly between the two bounds."""
    return (F.col(moment) > F.col(start)) & (F.col(moment) < F.col(end))


def age_at(moment: str = "admittime") -> Column:
    """Age from the anchor age and anchor year of the patient."""
    return F.col("anchor_age") + (F.year(moment) - F.col("anchor_year"))
