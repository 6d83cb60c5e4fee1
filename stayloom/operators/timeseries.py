"""Vital signs: pivot, cleaning, fixed time bins and padded sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayloom.functions.times import hours_between
from stayloom.functions.values import clip_outliers, quoted
from stayloom.operators.ordered import exact_quantiles, fill_gaps, positions
from stayloom.operators.windows import in_window
from stayloom.session import settle

READING = ["hadm_id", "stay_id", "charttime"]


def windowed_readings(events: DataFrame, windows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Readings with one of `labels` strictly inside the window of their stay."""
    order = [c for c in ("storetime", "itemid") if c in events.columns]
    return in_window(
        events.where(F.col("label").isin(list(labels))), windows, ["hadm_id", "stay_id"], "charttime",
        [*READING, "label", "valuenum", *order],
    )


def pivot_readings(readings: DataFrame, labels: Sequence[str], skip_null: bool = False) -> DataFrame:
    """One row per (stay, charttime) and one column per label.

    Of several readings in one cell the first by storetime, item and value counts, also when it
    is NULL unless `skip_null`.  One aggregation with map-side combine fills all columns.
    """
    order = [c for c in ("storetime", "itemid") if c in readings.columns]
    value = F.nanvl(F.col("valuenum").cast("double"), F.lit(None).cast("double"))
    reading = F.struct(*order, value.alias("valuenum"))

    def cell(label: str) -> Column:
        wanted = F.col("label") == label
        if skip_null:
            wanted = wanted & value.isNotNull()
        return F.min(F.when(wanted, reading))["valuenum"].alias(label)

    return readings.groupBy(*READING).agg(*[cell(v) for v in labels])


def with_elapsed_hours(series: DataFrame, key: str = "stay_id", at: str = "charttime") -> DataFrame:
    """Add frac_charttime: hours since the first row of the stay."""
    first = series.groupBy(key).agg(F.min(at).alias("_first"))
    return series.join(first, key).select(
        *[quoted(c) for c in series.columns], hours_between("_first", at).alias("frac_charttime")
    )


def time_series(events: DataFrame, windows: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Window, pivot and elapsed hours: the irregular wide series of every stay.

    The pivot is settled, since its rows and each stay's first time both come from it.
    """
    return with_elapsed_hours(settle(pivot_readings(windowed_readings(events, windows, labels), labels)))


def last_hours(series: DataFrame, hours: float = 2, key: str = "stay_id") -> DataFrame:
    """Rows within `hours` of the last row of their stay."""
    last = series.groupBy(key).agg(F.max("frac_charttime").alias("_last"))
    return series.join(last, key).where(F.col("frac_charttime") >= F.col("_last") - hours).select(
        *[quoted(c) for c in series.columns]
    )


# --- cleaning and filling -----------------------------------------------------------------------


def missing_mask(df: DataFrame, columns: Sequence[str], prefix: str = "mask_") -> DataFrame:
    """1 where a value is present, 0 where it is missing."""
    return df.withColumns({f"{prefix}{c}": quoted(c).isNotNull().cast("int") for c in columns})


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact median of the present values of each column, as (variable, median)."""
    return exact_quantiles(_unpivot(df, columns), ["variable"], "value", {"median": 0.5})


def column_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of the present values of each column, as (variable, mean)."""
    return _unpivot(df, columns).groupBy("variable").agg(F.avg("value").alias("mean"))


def _unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    values = df.select(*[quoted(c).cast("double").alias(c) for c in columns])
    return values.unpivot([], [quoted(c) for c in columns], "variable", "value").where(
        "value IS NOT NULL"
    )


def fill_values(df: DataFrame, columns: Sequence[str], method: str) -> dict[str, float]:
    """The value that fills the gaps of each column; one number per column."""
    if method == "zero":
        return {c: 0.0 for c in columns}
    fitted = column_medians(df, columns) if method == "median" else column_means(df, columns)
    return {r[0]: r[1] for r in fitted.collect()}


def fill_with(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Put a fixed value per column into its gaps."""
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(v)) for c, v in values.items()})


def stay_fill(df: DataFrame, columns: Sequence[str], method: str, key: str = "stay_id") -> DataFrame:
    """Fill the gaps of each stay with the mean or median of its own present values."""
    if method == "mean":
        own = df.groupBy(key).agg(*[F.avg(quoted(c)).alias(f"_own_{c}") for c in columns])
    else:
        present = df.select(key, *[quoted(c).cast("double").alias(c) for c in columns]).unpivot(
            [key], [quoted(c) for c in columns], "variable", "value"
        )
        medians = exact_quantiles(present, [key, "variable"], "value", {"median": 0.5})
        own = medians.groupBy(key).agg(
            *[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(f"_own_{c}") for c in columns]
        )
    return df.join(own, key, "left").select(
        *[
            F.coalesce(quoted(c), quoted(f"_own_{c}")).alias(c) if c in columns else quoted(c)
            for c in df.columns
        ]
    )


def impute(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "forward",
    key: str | None = None,
    order: str = "charttime",
) -> DataFrame:
    """Fill gaps: forward then backward, or with the mean, the median or zero.

    With `key` the fill values come from the rows of the same key, without it from all rows.
    """
    if method not in ("forward", "mean", "median", "zero"):
        raise ValueError(f"unknown imputation method {method!r}")
    if method == "forward":
        return fill_gaps(df, [key] if key else [], order, columns)
    if method == "zero" or key is None:
        return fill_with(df, fill_values(df, columns, method))
    return stay_fill(df, columns, method, key)


def preprocess(
    series: DataFrame,
    variables: Sequence[str],
    total_length: float,
    bounds: Mapping[str, Sequence[float]],
    medians: Mapping[str, float],
    method: str = "forward",
) -> DataFrame:
    """Clip, cut to `total_length` hours, note what was present, fill within the stay, then the medians."""
    clean = clip_outliers(series, bounds).where(F.col("frac_charttime") < total_length)
    marked = missing_mask(clean, variables)
    return fill_with(impute(marked, variables, method, key="stay_id"), medians)


def global_medians(
    series: DataFrame, variables: Sequence[str], total_length: float, bounds: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Median of each variable over all cleaned rows within `total_length` hours."""
    clean = clip_outliers(series, bounds).where(F.col("frac_charttime") < total_length)
    return column_medians(clean, variables)


# --- fixed time bins ----------------------------------------------------------------------------


def bin_count(total_length: int, bin_length: int) -> int:
    if total_length % bin_length != 0:
        raise ValueError(f"{total_length} hours do not divide into bins of {bin_length} hours")
    return total_length // bin_length


def bin_means(series: DataFrame, variables: Sequence[str], total_length: int, bin_length: int) -> DataFrame:
    """Mean of each variable per stay and time bin, for the bins that have rows."""
    bin_count(total_length, bin_length)
    return (
        series.where(F.col("frac_charttime") < total_length)
        .withColumn("time_bin", F.floor(F.col("frac_charttime") / bin_length).cast("int"))
        .groupBy("stay_id", "time_bin")
        .agg(*[F.avg(quoted(v)).alias(v) for v in variables])
    )


def time_bins(
    series: DataFrame, stays: DataFrame, variables: Sequence[str], total_length: int, bin_length: int
) -> DataFrame:
    """Mean of each variable per stay and time bin; every stay has every bin."""
    means = bin_means(series, variables, total_length, bin_length)
    last = F.lit(bin_count(total_length, bin_length) - 1)
    grid = stays.select("stay_id").distinct().withColumn("time_bin", F.explode(F.sequence(F.lit(0), last)))
    return grid.join(means, ["stay_id", "time_bin"], "left").select(
        "stay_id", "time_bin", *[quoted(v) for v in variables]
    )


def flat_names(variables: Sequence[str], n_bins: int) -> list[str]:
    """Names of the flattened bins, all bins of one variable together."""
    return [f"{v}_{b}" for v in variables for b in range(n_bins)]


def bin_vectors(
    means: DataFrame, stays: DataFrame, variables: Sequence[str], n_bins: int, method: str | None = None
) -> DataFrame:
    """(stay_id, values): the bins of each stay as one array, all bins of one variable together.

    A stay has at most `n_bins` rows to gather.  With `method` its gaps are filled from its own bins.
    """
    if method == "forward":
        filled = _carried_bins(means, variables, n_bins)
    else:
        filled = _dense_bins(means, variables, n_bins, method)
    # Stays without rows join last: there is nothing to work out for them.
    nothing = F.array_repeat(F.lit(None).cast("double"), n_bins * len(variables))
    return stays.select("stay_id").distinct().join(filled, "stay_id", "left").select(
        "stay_id", F.coalesce("values", nothing).alias("values")
    )


def _carried_bins(means: DataFrame, variables: Sequence[str], n_bins: int) -> DataFrame:
    """(stay_id, values) with the last value before each gap, or the first one after it.

    Values are carried from row to row; a row then stands for all bins up to the next one.
    """
    here = Window.partitionBy("stay_id").orderBy("time_bin")
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = [
        F.coalesce(F.last(quoted(v), ignorenulls=True).over(up_to), F.first(quoted(v), ignorenulls=True).over(whole)).alias(f"v{i}")
        for i, v in enumerate(variables)
    ]
    begin = F.when(F.row_number().over(here) == 1, F.lit(0)).otherwise(F.col("time_bin"))
    span = F.coalesce(F.lead("time_bin").over(here), F.lit(n_bins)) - begin
    rows = means.select("stay_id", "time_bin", span.alias("span"), *carried)
    members = F.struct("time_bin", "span", *[f"v{i}" for i in range(len(variables))])
    gathered = rows.groupBy("stay_id").agg(F.array_sort(F.collect_list(members)).alias("rows"))

    def column(i: int) -> Column:
        return F.flatten(F.transform("rows", lambda r: F.array_repeat(r[f"v{i}"], r["span"])))

    return gathered.select("stay_id", F.concat(*[column(i) for i in range(len(variables))]).alias("values"))


def _dense_bins(means: DataFrame, variables: Sequence[str], n_bins: int, method: str | None) -> DataFrame:
    """(stay_id, values) with gaps filled by a value of the whole stay, or left."""
    row = F.struct(*[quoted(v).alias(f"v{i}") for i, v in enumerate(variables)])
    entries = F.collect_list(F.struct("time_bin", row.alias("row")))
    rows = means.groupBy("stay_id").agg(F.map_from_entries(entries).alias("rows"))
    bins = F.sequence(F.lit(0), F.lit(n_bins - 1))
    dense = rows.select("stay_id", F.transform(bins, lambda b: F.try_element_at("rows", b)).alias("bins"))

    def column(i: int) -> Column:
        return F.transform("bins", lambda r: r[f"v{i}"])

    values = F.concat(*[_fill_array(column(i), method) for i in range(len(variables))])
    return dense.select("stay_id", values.alias("values"))


def _fill_array(values: Column, method: str | None) -> Column:
    """Fill the NULLs of an array from its other elements."""
    if method is None:
        return values
    known = F.filter(values, lambda x: x.isNotNull())
    if method == "zero":
        return {c: 0.0 for c in columns}
    fitted = column_medians(df, columns) if method == "median" else column_means(df, columns)
    return {r[0]: r[1] for r in fitted.collect()}


def fill_with(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Put a fixed value per column into its gaps."""
    return df.withColumns({c: F.coalesce(quoted(c), F.lit(v)) for c, v in values.items()})


def stay_fill(df: DataFrame, columns: Sequence[str], method: str, key: str = "stay_id") -> DataFrame:
    """Fill the gaps of each stay with the mean or median of its own present values."""
    if method == "mean":
        own = df.groupBy(key).agg(*[F.avg(quoted(c)).alias(f"_own_{c}") for c in columns])
    else:
        present = df.select(key, *[quoted(c).cast("double").alias(c) for c in columns]).unpivot(
            [key], [quoted(c) for c in columns], "variable", "value"
        )
        medians = exact_quantiles(present, [key, "variable"], "value", {"median": 0.5})
        own = medians.groupBy(key).agg(
            *[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(f"_own_{c}") for c in columns]
        )
    return df.join(own, key, "left").select(
        *[
            F.coalesce(quoted(c), quoted(f"_own_{c}")).alias(c) if c in columns else quoted(c)
            for c in df.columns
        ]
    )


def impute(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "forward",
    key: str | None = None,
    order: str = "charttime",
) -> DataFrame:
    """Fill gaps: forward then backward, or with the mean, the median or zero.

    With `key` the fill values come from the rows of the same key, without it from all rows.
    """
    if method not in ("forward", "mean", "median", "zero"):
        raise ValueError(f"unknown imputation method {method!r}")
    if method == "forward":
        return fill_gaps(df, [key] if key else [], order, columns)
    if method == "zero" or key is None:
        return fill_with(df, fill_values(df, columns, method))
    return stay_fill(df, columns, method, key)


def preprocess(
    series: DataFrame,
    variables: Sequence[str],
    total_length: float,
    bounds: Mapping[str, Sequence[float]],
    medians: Mapping[str, float],
    method: str = "forward",
) -> DataFrame:
    """Clip, cut to `total_length` hours, note what was present, fill within the stay, then the medians."""
    clean = clip_outliers(series, bounds).where(F.col("frac_charttime") < total_length)
    marked = missing_mask(clean, variables)
    return fill_with(impute(marked, variables, method, key="stay_id"), medians)


def global_medians(
    series: DataFrame, variables: Sequence[str], total_length: float, bounds: Mapping[str, Sequence[float]]
) -> DataFrame:
    """Median of each variable over all cleaned rows within `total_length` hours."""
    clean = clip_outliers(series, bounds).where(F.col("frac_charttime") < total_length)
    return column_medians(clean, variables)


# --- fixed time bins ----------------------------------------------------------------------------


def bin_count(total_length: int, bin_length: int) -> int:
    if total_length % bin_length != 0:
        raise ValueError(f"{total_length} hours do not divide into bins of {bin_length} hours")
    return total_length // bin_length


def bin_means(series: DataFrame, variables: Sequence[str], total_length: int, bin_length: int) -> DataFrame:
    """Mean of each variable per stay and time bin, for the bins that have rows."""
    bin_count(total_length, bin_length)
    return (
        series.where(F.col("frac_charttime") < total_length)
        .withColumn("time_bin", F.floor(F.col("frac_charttime") / bin_length).cast("int"))
        .groupBy("stay_id", "time_bin")
        .agg(*[F.avg(quoted(v)).alias(v) for v in variables])
    )


def time_bins(
    series: DataFrame, stays: DataFrame, variables: Sequence[str], total_length: int, bin_length: int
) -> DataFrame:
    """Mean of each variable per stay and time bin; every stay has every bin."""
    means = bin_means(series, variables, total_length, bin_length)
    last = F.lit(bin_count(total_length, bin_length) - 1)
    grid = stays.select("stay_id").distinct().withColumn("time_bin", F.explode(F.sequence(F.lit(0), last)))
    return grid.join(means, ["stay_id", "time_bin"], "left").select(
        "stay_id", "time_bin", *[quoted(v) for v in variables]
    )


def flat_names(variables: Sequence[str], n_bins: int) -> list[str]:
    """Names of the flattened bins, all bins of one variable together."""
    return [f"{v}_{b}" for v in variables for b in range(n_bins)]


def bin_vectors(
    means: DataFrame, stays: DataFrame, variables: Sequence[str], n_bins: int, method: str | None = None
) -> DataFrame:
    """(stay_id, values): the bins of each stay as one array, all bins of one variable together.

    A stay has at most `n_bins` rows to gather.  With `method` its gaps are filled from its own bins.
    """
    if method == "forward":
        filled = _carried_bins(means, variables, n_bins)
    else:
        filled = _dense_bins(means, variables, n_bins, method)
    # Stays without rows join last: there is nothing to work out for them.
    nothing = F.array_repeat(F.lit(None).cast("double"), n_bins * len(variables))
    return stays.select("stay_id").distinct().join(filled, "stay_id", "left").select(
        "stay_id", F.coalesce("values", nothing).alias("values")
    )


def _carried_bins(means: DataFrame, variables: Sequence[str], n_bins: int) -> DataFrame:
    """(stay_id, values) with the last value before each gap, or the first one after it.

    Values are carried from row to row; a row then stands for all bins up to the next one.
    """
    here = Window.partitionBy("stay_id").orderBy("time_bin")
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = [
        F.coalesce(F.last(quoted(v), ignorenulls=True).over(up_to), F.first(quoted(v), ignorenulls=True).over(whole)).alias(f"v{i}")
        for i, v in enumerate(variables)
    ]
    begin = F.when(F.row_number().over(here) == 1, F.lit(0)).otherwise(F.col("time_bin"))
    span = F.coalesce(F.lead("time_bin").over(here), F.lit(n_bins)) - begin
    rows = means.select("stay_id", "time_bin", span.alias("span"), *carried)
    members = F.struct("time_bin", "span", *[f"v{i}" for i in range(len(variables))])
    gathered = rows.groupBy("stay_id").agg(F.array_sort(F.collect_list(members)).alias("rows"))

    def column(i: int) -> Column:
        return F.flatten(F.transform("rows", lambda r: F.array_repeat(r[f"v{i}"], r["span"])))

    return gathered.select("stay_id", F.concat(*[column(i) for i in range(len(variables))]).alias("values"))


def _dense_bins(means: DataFrame, variables: Sequence[str], n_bins: int, method: str | None) -> DataFrame:
    """(stay_id, values) with gaps filled by a value of the whole stay, or left."""
    row = F.struct(*[quoted(v).alias(f"v{i}") for i, v in enumerate(variables)])
    entries = F.collect_list(F.struct("time_bin", row.alias("row")))
    rows = means.groupBy("stay_id").agg(F.map_from_entries(entries).alias("rows"))
    bins = F.sequence(F.lit(0), F.lit(n_bins - 1))
    dense = rows.select("stay_id", F.transform(bins, lambda b: F.try_element_at("rows", b)).alias("bins"))

    def column(i: int) -> Column:
        return F.transform("bins", lambda r: r[f"v{i}"])

    values = F.concat(*[_fill_array(column(i), method) for i in range(len(variables))])
    return dense.select("stay_id", values.alias("values"))


def _fill_array(values: Column, method: str | None) -> Column:
    """Fill the NULLs of an array from its other elements."""
    if method is None:
        return values
    known = F.filter(values, lambda x: x.isNotNull())
    if method == "forward":
        missing = F.lit(None).cast("double")
        start = F.struct(missing.alias("last"), F.array().cast("array<double>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            latest = F.coalesce(x, state["last"])
            return F.struct(latest.alias("last"), F.concat(state["out"], F.array(latest)).alias("out"))

        return F.transform(
            F.aggregate(values, start, step, lambda state: state["out"]),
            lambda x: F.coalesce(x, F.get(known, F.lit(0))),
        )
    if method == "zero":
        filler = F.lit(0.0)
    elif method == "mean":
        filler = F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known).cast("double"))
    elif method == "median":
        ordered, size = F.array_sort(known), F.size(known)
        low = F.get(ordered, F.floor((size - 1) / 2).cast("int"))
        filler = (low + F.get(ordered, F.floor(size / 2).cast("int"))) / 2
    else:
        raise ValueError(f"unknown imputation method {method!r}")
    return F.transform(values, lambda x: F.coalesce(x, filler))


def spread_vector(vectors: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per element of `values`."""
    return vectors.select("stay_id", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)])


def flatten_bins(means: DataFrame, stays: DataFrame, variables: Sequence[str], n_bins: int) -> DataFrame:
    """One row per stay with a column `<variable>_<bin>` for each bin."""
    return spread_vector(bin_vectors(means, stays, variables, n_bins), flat_names(variables, n_bins))


def element_medians(vectors: DataFrame) -> dict[int, float]:
    """Exact median of the present values at each place of `values`."""
    places = vectors.select(F.posexplode("values").alias("place", "value"))
    return {r["place"]: r["median"] for r in exact_quantiles(places, ["place"], "value", {"median": 0.5}).collect()}


def fixed_interval_vectors(
    series: DataFrame,
    stays: DataFrame,
    variables: Sequence[str],
    bounds: Mapping[str, Sequence[float]],
    total_length: int = 24,
    bin_length: int = 1,
    method: str = "forward",
    median_stays: DataFrame | None = None,
) -> DataFrame:
    """Binned features of every stay as (stay_id, values): clean, bin, fill within the stay, medians.

    A stay without rows keeps NULLs until the medians fill them.  Medians are learnt from
    `median_stays` (the training split), or from all stays when it is None.
    """
    n_bins = bin_count(total_length, bin_length)
    means = bin_means(clip_outliers(series, bounds), variables, total_length, bin_length)
    vectors = settle(bin_vectors(means, stays, variables, n_bins, method))
    learnt_on = vectors if median_stays is None else vectors.join(
        median_stays.select("stay_id").distinct(), "stay_id", "left_semi"
    )
    medians = element_medians(learnt_on)
    middle = F.array(*[F.lit(medians.get(i)).cast("double") for i in range(n_bins * len(variables))])
    return vectors.select("stay_id", F.zip_with("values", middle, lambda x, m: F.coalesce(x, m)).alias("values"))


def fixed_interval_features(
    series: DataFrame,
    stays: DataFrame,
    variables: Sequence[str],
    bounds: Mapping[str, Sequence[float]],
    total_length: int = 24,
    bin_length: int = 1,
    method: str = "forward",
    median_stays: DataFrame | None = None,
) -> DataFrame:
    """`fixed_interval_vectors` with one column `<variable>_<bin>` per element."""
    vectors = fixed_interval_vectors(
        series, stays, variables, bounds, total_length, bin_length, method, median_stays
    )
    return spread_vector(vectors, flat_names(variables, bin_count(total_length, bin_length)))


# --- sequences ----------------------------------------------------------------------------------


def pad_length(series: DataFrame, share: float = 0.999) -> DataFrame:
    """Whole part of the `share` quantile of the number of rows per stay."""
    lengths = series.groupBy("stay_id").agg(F.count(F.lit(1)).alias("length"))
    return exact_quantiles(lengths, [], "length", {"pad_length": share}).select(
        F.floor("pad_length").alias("pad_length")
    )


def padded_sequences(
    series: DataFrame,
    columns: Sequence[str],
    length: int,
    order: str = "charttime",
    key: str = "stay_id",
) -> DataFrame:
    """Per stay the first `length` rows of each column as arrays padded with 0, and a validity mask.

    Rows beyond `length` are left out before anything is gathered, so an array never holds more.
    """
    numbered = positions(series.select(key, order, *[quoted(c) for c in columns if c not in (key, order)]), order, [key])
    kept = numbered.where(F.col("position") <= length)
    rows = kept.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("position", *[quoted(c).alias(f"c{i}") for i, c in enumerate(columns)]))).alias("rows")
    )
    slots = F.sequence(F.lit(0), F.lit(length - 1))

    def padded(field: str) -> Column:
        return F.transform(slots, lambda i: F.coalesce(F.get("rows", i)[field].cast("double"), F.lit(0.0)))

    return rows.select(
        key,
        *[padded(f"c{i}").alias(c) for i, c in enumerate(columns)],
        F.transform(slots, lambda i: (i < F.size("rows")).cast("int")).alias("input_mask"),
    )


def sequence_tensor(
    prepared: DataFrame, variables: Sequence[str], scaler: Mapping[str, tuple[float, float]], length: int
) -> DataFrame:
    """Scaled values, presence masks and elapsed hours of each stay as one padded matrix.

    `prepared` comes from `preprocess`; `scaler` maps a variable to its training mean and deviation.
    `tensor` holds `length` rows of 2 · variables + 1 numbers.
    """
    scaled = prepared.withColumns(
        {v: (quoted(v) - F.lit(m)) / F.lit(s) for v, (m, s) in scaler.items()}
    )
    order = [*variables, *[f"mask_{v}" for v in variables], "frac_charttime"]
    padded = padded_sequences(scaled, order, length)
    slots = F.sequence(F.lit(0), F.lit(length - 1))
    return padded.select(
        "stay_id",
        F.transform(slots, lambda i: F.array(*[F.get(quoted(c), i) for c in order])).alias("tensor"),
        "input_mask",
    )
