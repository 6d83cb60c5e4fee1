"""Join shapes of the cohort work.

None of them hints a broadcast: Spark broadcasts a side when its measured size is under the
session's threshold and otherwise shuffles on the key, and adaptive execution splits the
partitions of a hot key on the side where that is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.functions.values import quoted


def known(column: str) -> Column:
    """Whether a value is there, said as a comparison, which is true of every value.

    By a comparison Spark takes a written table for a selective side of its joins and filters the other
    sides by its keys before they are shuffled (runtime filters, see session.SETTINGS).
    """
    return F.col(column).cast("string") >= F.lit("")


def restrict(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key occurs in `keys`; column order is kept."""
    return df.join(keys.select(*on), list(on), "left_semi").select(*[quoted(c) for c in df.columns])


def look_up(
    df: DataFrame, dictionary: DataFrame, on: Sequence[str] | dict[str, str], columns: Sequence[str]
) -> DataFrame:
    """Attach dictionary columns by key, keeping rows without an entry.

    `on` may map a column of `df` to a differently named key of the dictionary.
    """
    pairs = on if isinstance(on, dict) else {k: k for k in on}
    entries = dictionary.select(
        *[F.col(theirs).alias(f"_key_{ours}") for ours, theirs in pairs.items()],
        *[F.col(c) for c in columns],
    )
    condition = [df[ours] == entries[f"_key_{ours}"] for ours in pairs]
    return df.join(entries, condition, "left").drop(*[f"_key_{ours}" for ours in pairs])


def with_details(
    header: DataFrame, detail: DataFrame, on: Sequence[str], drop: Sequence[str] = (), prefix: str = "detail_"
) -> DataFrame:
    """Attach every detail row to its header row; headers without detail keep one row of NULLs.

    A left join could not be split where one header owns much of the detail side, so matched rows
    come from an inner join (either side may be split) and the others from an anti join with
    the distinct detail keys.  Detail columns whose name the header has too get `prefix`.
    """
    detail = detail.drop(*[c for c in drop if c not in on])
    taken = {c: prefix + c for c in detail.columns if c not in on and c in header.columns}
    detail = detail.withColumnsRenamed(taken)
    matched = header.join(detail, list(on), "inner")
    alone = header.join(detail.select(*on).distinct(), list(on), "left_anti")
    extra = [c for c in detail.columns if c not in on]
    return matched.unionByName(alone, allowMissingColumns=True).select(
        *[quoted(c) for c in header.columns], *[quoted(c) for c in extra]
    )


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    on: Sequence[str],
    at: str,
    start: str,
    end: str,
    width_days: int = 7,
) -> DataFrame:
    """Pairs of a span and a point of the same key inside it, both ends included.

    Both sides also carry the number of a `width_days` wide period, spans one copy for each
    period they touch, so a key with very many points and spans is spread over its periods
    instead of being compared in full.  A pair meets in exactly one period.
    """
    period = "_period"

    def period_of(moment: str):
        return F.floor(F.unix_date(F.to_date(moment)) / F.lit(width_days))

    spans = spans.where(F.col(start) <= F.col(end)).withColumn(
        period, F.explode(F.sequence(period_of(start), period_of(end)))
    )
    points = points.where(F.col(at).isNotNull()).withColumn(period, period_of(at))
    pairs = spans.join(points, [*on, period])
    return pairs.where((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end))).drop(period)
