"""Order-dependent operators whose work per task stays bounded when one key holds most rows.

A window partitioned by a key alone sends all rows of that key to one task.  Here the order
column is first cut into slices at approximate quantiles of all rows; a window then runs per
(key, slice), and what a slice needs from its neighbours comes from one summary row per
(key, slice).  A slice holds about `rows_per_slice` rows whichever key they belong to, plus the
rows that share one order value.  Every input takes this way, also one of a single slice.

The cut points only balance the work: any cut points give the same result.  They are fetched once
(at most MAX_SLICES numbers, beyond which slices grow) and fixed in the plan, so that repeated and
retried stages agree.  NULL keys are a key of their own.  Rows without an order value are a slice of
their own, which stands where Spark orders NULL: before the others going up, after them going down.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayloom.functions.values import quoted

ROWS_PER_SLICE = 1_000_000
MAX_SLICES = 10_000
_GRID = 1_000
SLICE_SETTING = "spark.stayloom.rowsPerSlice"
_SLICE, _NUMBER = "_slice", "_number"


def _number_of(df: DataFrame, column: str) -> Column:
    """The order value as a double; larger values never map to smaller doubles."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(quoted(column).cast("timestamp")).cast("double")
    return quoted(column).cast("double")


def cut_points(df: DataFrame, column: str, rows_per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Where to cut `column` so that each slice holds about `rows_per_slice` rows.

    The session setting spark.stayloom.rowsPerSlice, when there, takes its place.
    """
    per_slice = int(df.sparkSession.conf.get(SLICE_SETTING, str(rows_per_slice)))
    numbers = df.select(_number_of(df, column).alias(_NUMBER))

    def quantiles(slices: int) -> Column:
        shares = ", ".join(f"{i / slices}D" for i in range(1, slices))
        return F.expr(f"percentile_approx({_NUMBER}, array({shares}), {10 * slices})").alias("cuts")

    found = numbers.agg(F.count(F.lit(1)).alias("rows"), quantiles(_GRID)).first()
    slices = min(MAX_SLICES, -(-found["rows"] // per_slice))
    if slices < 2:
        return []
    if slices > _GRID:
        found = numbers.agg(quantiles(slices)).first()
        return sorted({c for c in found["cuts"] or [] if math.isfinite(c)})
    grid = found["cuts"] or []
    at = [round(i * _GRID / slices) - 1 for i in range(1, slices)] if grid else []
    return sorted({grid[i] for i in at if math.isfinite(grid[i])})


def with_slice(df: DataFrame, column: str, cuts: Sequence[float]) -> DataFrame:
    """Add the number of the slice each row falls into; NULL where the column is."""
    number = F.lit(0)
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        bucketizer = Bucketizer(splits=splits, inputCol=_NUMBER, outputCol="_bucket", handleInvalid="keep")
        df = bucketizer.transform(df.withColumn(_NUMBER, _number_of(df, column)))
        number = F.col("_bucket").cast("int")
    return df.withColumn(_SLICE, F.when(quoted(column).isNotNull(), number)).drop(_NUMBER, "_bucket")


def _beside(rows: DataFrame, summary: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each row with the summary of its (key, slice); NULL keys and slices match."""
    keys = [*by, _SLICE]
    named = summary.withColumnsRenamed({c: f"_of_{i}" for i, c in enumerate(keys)})
    same = reduce(lambda a, b: a & b, (rows[f"`{c}`"].eqNullSafe(named[f"_of_{i}"]) for i, c in enumerate(keys)))
    return rows.join(named, same).drop(*[f"_of_{i}" for i in range(len(keys))])


def _plus(a: Column, b: Column) -> Column:
    """The sum of what is known of both, as `sum` has it."""
    return F.coalesce(a + b, a, b)


def _cuts(df: DataFrame, order: str, cuts: Sequence[float] | None) -> Sequence[float]:
    return cut_points(df, order) if cuts is None else cuts


def running_sum(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """One row per (by, order): the sums there, `cum_*` up to and including it, `total_*` of the key."""
    cuts = _cuts(df, order, cuts)
    cells = df.groupBy(*by, order).agg(*[F.sum(s).alias(s) for s in sums])
    step = quoted(order).desc() if descending else quoted(order).asc()
    cells = with_slice(cells, order, cuts)
    rank = F.col(_SLICE).desc() if descending else F.col(_SLICE).asc()
    slices = Window.partitionBy(*by).orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    before = cells.groupBy(*by, _SLICE).agg(*[F.sum(s).alias(s) for s in sums]).select(
        *by, _SLICE,
        *[F.sum(s).over(slices).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(Window.partitionBy(*by)).alias(f"total_{s}") for s in sums],
    )
    within = Window.partitionBy(*by, _SLICE).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return _beside(cells, before, by).select(
        *by, order, *sums,
        *[_plus(F.sum(s).over(within), F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def positions(
    df: DataFrame,
    order: str,
    by: Sequence[str] = (),
    ties: Sequence[str] = (),
    name: str = "position",
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, … by `order` and then `ties`, NULLs last."""
    cuts = _cuts(df, order, cuts)
    steps = [quoted(c).asc_nulls_last() for c in (order, *ties)]
    columns = [quoted(c) for c in df.columns]
    rows = with_slice(df, order, cuts)
    slices = Window.partitionBy(*by).orderBy(F.col(_SLICE).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*by, _SLICE).agg(F.count(F.lit(1)).alias("_n")).select(
        *by, _SLICE, F.coalesce(F.sum("_n").over(slices), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(*by, _SLICE).orderBy(*steps)
    return _beside(rows, before, by).select(
        *columns, (F.row_number().over(within) + F.col("_before")).cast("bigint").alias(name)
    )


def next_value(
    df: DataFrame, by: Sequence[str], order: str, name: str, cuts: Sequence[float] | None = None
) -> DataFrame:
    """Distinct (by, order) with the next larger order value of the same key, or NULL."""
    cuts = _cuts(df, order, cuts)
    cells = df.select(*by, order).distinct()
    cells = with_slice(cells, order, cuts)
    after = cells.groupBy(*by, _SLICE).agg(F.min(order).alias("_first")).select(
        *by, _SLICE, F.lead("_first").over(Window.partitionBy(*by).orderBy(_SLICE)).alias("_after")
    )
    within = Window.partitionBy(*by, _SLICE).orderBy(order)
    return _beside(cells, after, by).select(
        *by, order, F.coalesce(F.lead(order).over(within), F.col("_after")).alias(name)
    )


def fill_gaps(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    columns: Sequence[str],
    backward: bool = True,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Replace NULLs by the last value before, then (with `backward`) by the first value after.

    `order` must be unique within a key; one row of a key may have none and then comes first.
    """
    cuts = _cuts(df, order, cuts)
    rows = with_slice(df, order, cuts)
    within = Window.partitionBy(*by, _SLICE).orderBy(order)
    up_to = within.rowsBetween(Window.unboundedPreceding, 0)
    # A value still missing after filling forward has nothing known before it, so the first known
    # value of the whole slice is the first one after it; a frame per row is not needed.
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = _beside(rows, _edges(rows, by, order, columns, backward), by)

    def filled(i: int, c: str) -> Column:
        sources = [F.last(quoted(c), ignorenulls=True).over(up_to), F.col(f"_carry_{i}")]
        if backward:
            sources += [F.first(quoted(c), ignorenulls=True).over(whole), F.col(f"_ahead_{i}")]
        return F.coalesce(*sources).alias(c)

    new = {c: filled(i, c) for i, c in enumerate(columns)}
    return rows.select(*[new.get(c, quoted(c)) for c in df.columns])


def _edges(
    rows: DataFrame, by: Sequence[str], order: str, columns: Sequence[str], backward: bool
) -> DataFrame:
    """Per (key, slice) the last known value of earlier slices and the first one of the key."""
    slices = Window.partitionBy(*by).orderBy(_SLICE)
    earlier = slices.rowsBetween(Window.unboundedPreceding, -1)
    whole = slices.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends, carried = [], []
    for i, c in enumerate(columns):
        known = F.when(quoted(c).isNotNull(), quoted(order))
        unordered = F.max(F.when(quoted(order).isNull(), quoted(c)))
        ends.append(F.coalesce(F.max_by(quoted(c), known), unordered).alias(f"_last_{i}"))
        carried.append(F.last(f"_last_{i}", ignorenulls=True).over(earlier).alias(f"_carry_{i}"))
        if backward:
            ends.append(F.coalesce(F.min_by(quoted(c), known), unordered).alias(f"_first_{i}"))
            carried.append(F.first(f"_first_{i}", ignorenulls=True).over(whole).alias(f"_ahead_{i}"))
    return rows.groupBy(*by, _SLICE).agg(*ends).select(*by, _SLICE, *carried)


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, shares: dict[str, float], digits: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles of the non-null values, one row per key.

    The built-in exact percentile keeps every distinct value of a key in one buffer; this
    counts equal values first and finds the wanted ranks with running totals.
    """
    known = df.where(quoted(value).isNotNull()).select(*by, value).withColumn("rows", F.lit(1))
    counts = running_sum(known, by, value, ["rows"])
    found, results = [], []
    for i, (name, share) in enumerate(shares.items()):
        rank = F.lit(float(share)) * (F.col("total_rows") - 1)
        for end, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            here = (F.col("cum_rows") > at) & (F.col("cum_rows") - F.col("rows") <= at)
            found.append(F.max(F.when(here, quoted(value).cast("double"))).alias(f"_{end}_{i}"))
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        result = low + (high - low) * (rank - F.floor(rank))
        results.append((F.round(result, digits) if digits is not None else result).alias(name))
    return counts.groupBy(*by, "total_rows").agg(*found).select(*by, *results)
