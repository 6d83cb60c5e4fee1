"""Vital-sign series over the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stayloom.config import VITAL_BOUNDS
from stayloom.driver.registry import query
from stayloom.driver.views import OBSERVED, VITALS, Views
from stayloom.functions.values import clip_outliers
from stayloom.operators import features, ordered, timeseries
from stayloom.session import settle

BOUNDS = {c: b for c, b in VITAL_BOUNDS.items() if c in OBSERVED}
TOTAL, BIN = 48, 6
N_BINS = TOTAL // BIN


def q(name: str) -> str:
    return f'"{name}"'


def _clean(name: str) -> str:
    if name not in BOUNDS:
        return q(name)
    low, valid_low, valid_high, high = (f"CAST({x} AS DOUBLE)" for x in BOUNDS[name])
    c = q(name)
    return (
        f"CASE WHEN {c} < {low} OR {c} > {high} THEN NULL WHEN {c} < {valid_low} THEN {valid_low} "
        f"WHEN {c} > {valid_high} THEN {valid_high} ELSE {c} END AS {c}"
    )


def columns(names, text) -> str:
    return ", ".join(text(n) for n in names)


CLEAN = f"SELECT hadm_id, stay_id, charttime, frac_charttime, {columns(OBSERVED, _clean)} FROM series"
SHORT = f"SELECT * FROM ({CLEAN}) WHERE frac_charttime < {TOTAL}"


def clean(v: Views):
    return clip_outliers(v.written_series, BOUNDS).select("hadm_id", "stay_id", "charttime", "frac_charttime", *OBSERVED)


@query("vitals_pivot", "SELECT * FROM pivoted", ["pivoted"])
def _(v: Views):
    return timeseries.pivot_readings(timeseries.windowed_readings(v["chartevents"], v.windows, VITALS), VITALS)


@query("frac_hours", "SELECT * FROM series", ["series"])
def _(v: Views):
    return v.series


@query("outlier_clip", CLEAN, ["series"])
def _(v: Views):
    return clip_outliers(v.series, BOUNDS).select("hadm_id", "stay_id", "charttime", "frac_charttime", *OBSERVED)


@query(
    "last_two_hours",
    """SELECT s.* FROM series s JOIN (SELECT stay_id, max(frac_charttime) AS last FROM series GROUP BY stay_id) m
           ON s.stay_id = m.stay_id WHERE s.frac_charttime >= m.last - 2""",
    ["series"],
)
def _(v: Views):
    return timeseries.last_hours(v.series, 2)


# --- filling ------------------------------------------------------------------------------------


def _filled(by: str, order: str):
    def text(c: str) -> str:
        return (
            f"coalesce(last_value({q(c)} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({q(c)} IGNORE NULLS) OVER (PARTITION BY {by} ORDER BY {order} "
            f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {q(c)}"
        )

    return text


@query(
    "ffill_bfill",
    f"SELECT stay_id, charttime, {columns(OBSERVED, _filled('stay_id', 'charttime'))} FROM series",
    ["series"],
)
def _(v: Views):
    return ordered.fill_gaps(v.written_series.select("stay_id", "charttime", *OBSERVED), ["stay_id"], "charttime", OBSERVED)


@query(
    "missing_mask",
    f"SELECT stay_id, charttime, {columns(VITALS, lambda c: f'CAST({q(c)} IS NOT NULL AS INTEGER) AS {q("mask_" + c)}')} FROM series",
    ["series"],
)
def _(v: Views):
    marked = timeseries.missing_mask(v.series, VITALS)
    return marked.select("stay_id", "charttime", *[f"mask_{c}" for c in VITALS])


MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, median({q(c)}) AS median FROM short WHERE {q(c)} IS NOT NULL" for c in OBSERVED
)


@query("global_median", f"WITH short AS ({SHORT}) {MEDIANS}", ["series"])
def _(v: Views):
    return timeseries.global_medians(v.written_series, OBSERVED, TOTAL, BOUNDS)


def _imputed(method: str) -> str:
    value = {"mean": "avg({c}) OVER ()", "median": "median({c}) OVER ()", "zero": "CAST(0 AS DOUBLE)"}[method]
    return (
        "SELECT stay_id, charttime, "
        + columns(OBSERVED, lambda c: f"round(coalesce({q(c)}, {value.format(c=q(c))}), 6) AS {q(c)}")
        + f" FROM ({CLEAN})"
    )


def _impute(method: str):
    def run(v: Views):
        filled = timeseries.impute(clean(v), OBSERVED, method)
        return filled.select("stay_id", "charttime", *[F.round(c, 6).alias(c) for c in OBSERVED])

    run.__doc__ = f"Gaps filled with the column's {method}."
    return run


query("impute_column", _imputed("mean"), ["series"])(_impute("mean"))
query("impute_median", _imputed("median"), ["series"])(_impute("median"))
query("impute_zero", _imputed("zero"), ["series"])(_impute("zero"))


def _own(c: str) -> str:
    return f"round(coalesce({q(c)}, median({q(c)}) OVER (PARTITION BY stay_id)), 6) AS {q(c)}"


@query("impute_stay_median", f"SELECT stay_id, charttime, {columns(OBSERVED, _own)} FROM ({CLEAN})", ["series"])
def _(v: Views):
    filled = timeseries.impute(clean(v), OBSERVED, "median", key="stay_id")
    return filled.select("stay_id", "charttime", *[F.round(c, 6).alias(c) for c in OBSERVED])


# --- fixed bins ---------------------------------------------------------------------------------

BINS = f"""
    SELECT g.stay_id, g.time_bin, {columns(OBSERVED, lambda c: f"m.{q(c)}")}
    FROM (SELECT stay_id, CAST(unnest(range({N_BINS})) AS INTEGER) AS time_bin FROM icustays) g
    LEFT JOIN (SELECT stay_id, CAST(floor(frac_charttime / {BIN}) AS INTEGER) AS time_bin,
                      {columns(OBSERVED, lambda c: f"avg({q(c)}) AS {q(c)}")}
               FROM ({SHORT}) GROUP BY ALL) m
        ON g.stay_id = m.stay_id AND g.time_bin = m.time_bin"""
FLAT = timeseries.flat_names(OBSERVED, N_BINS)


def _flat(source: str) -> str:
    cells = ", ".join(
        f"max(CASE WHEN time_bin = {b} THEN {q(c)} END) AS {q(f'{c}_{b}')}" for c in OBSERVED for b in range(N_BINS)
    )
    return f"SELECT stay_id, {cells} FROM ({source}) GROUP BY stay_id"


def bins(v: Views):
    return timeseries.time_bins(clean(v), v["icustays"], OBSERVED, TOTAL, BIN)


def rounded(df, names):
    return df.withColumns({c: F.round(f"`{c}`", 6) for c in names})


@query(
    "time_bin_mean",
    f"SELECT stay_id, time_bin, {columns(OBSERVED, lambda c: f'round({q(c)}, 6) AS {q(c)}')} FROM ({BINS})",
    ["series", "icustays"],
)
def _(v: Views):
    return rounded(bins(v), OBSERVED)


@query(
    "time_bin_flat",
    f"SELECT stay_id, {columns(FLAT, lambda c: f'round({q(c)}, 6) AS {q(c)}')} FROM ({_flat(BINS)})",
    ["series", "icustays"],
)
def _(v: Views):
    means = timeseries.bin_means(clean(v), OBSERVED, TOTAL, BIN)
    return rounded(timeseries.flatten_bins(means, v["icustays"], OBSERVED, N_BINS), FLAT)


SPLIT_NUMBER = "CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 7)) AS BIGINT) % 1000"
IS_TRAIN = SPLIT_NUMBER.format(key="stay_id") + " < 700"


def train(df):
    return df.where(features.split_of("stay_id") == "train")


@query(
    "ts_fixed_interval",
    f"""WITH flat AS ({_flat(f"SELECT stay_id, time_bin, {columns(OBSERVED, _filled('stay_id', 'time_bin'))} FROM ({BINS})")}),
        middle AS (SELECT {columns(FLAT, lambda c: f"median({q(c)}) AS {q(c)}")} FROM flat WHERE {IS_TRAIN})
        SELECT flat.stay_id, {columns(FLAT, lambda c: f"round(coalesce(flat.{q(c)}, middle.{q(c)}), 6) AS {q(c)}")}
        FROM flat, middle""",
    ["series", "icustays"],
)
def _(v: Views):
    stays = v["icustays"].select("stay_id")
    flat = timeseries.fixed_interval_features(
        v.written_series, stays, OBSERVED, BOUNDS, TOTAL, BIN, "forward", median_stays=train(stays)
    )
    return rounded(flat, FLAT)


# --- sequences ----------------------------------------------------------------------------------

PREPARED = f"""
    SELECT f.stay_id, f.charttime, f.frac_charttime,
           {columns(OBSERVED, lambda c: f"coalesce(f.{q(c)}, m.{q(c)}) AS {q(c)}")},
           {columns(OBSERVED, lambda c: f"f.{q('mask_' + c)}")}
    FROM (SELECT stay_id, charttime, frac_charttime, {columns(OBSERVED, _filled("stay_id", "charttime"))},
                 {columns(OBSERVED, lambda c: f"CAST({q(c)} IS NOT NULL AS INTEGER) AS {q('mask_' + c)}")}
          FROM ({SHORT})) f,
         (SELECT {columns(OBSERVED, lambda c: f"median({q(c)}) AS {q(c)}")} FROM ({SHORT}) WHERE {IS_TRAIN}) m"""


def prepared(v: Views):
    medians = timeseries.fill_values(
        clip_outliers(train(v.written_series), BOUNDS).where(F.col("frac_charttime") < TOTAL), OBSERVED, "median"
    )
    return timeseries.preprocess(v.written_series, OBSERVED, TOTAL, BOUNDS, medians)


@query(
    "ts_preprocess",
    f"""SELECT stay_id, charttime, frac_charttime, {columns(OBSERVED, lambda c: f"round({q(c)}, 6) AS {q(c)}")},
               {columns(OBSERVED, lambda c: q("mask_" + c))} FROM ({PREPARED})""",
    ["series"],
)
def _(v: Views):
    names = ["stay_id", "charttime", "frac_charttime", *OBSERVED, *[f"mask_{c}" for c in OBSERVED]]
    return rounded(prepared(v).select(*names), OBSERVED)


@query(
    "pad_length",
    """SELECT CAST(floor(quantile_cont(n, 0.999)) AS BIGINT) AS pad_length
       FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM series GROUP BY stay_id)""",
    ["series"],
)
def _(v: Views):
    return timeseries.pad_length(v.written_series)


def _slots(source: str) -> str:
    length = f"""(SELECT CAST(floor(quantile_cont(n, 0.999)) AS BIGINT)
                  FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM ({source}) GROUP BY stay_id))"""
    return f"""(SELECT stay_id, CAST(slot AS INTEGER) AS slot
                FROM (SELECT DISTINCT stay_id FROM ({source})), (SELECT unnest(range({length})) AS slot))"""


def learnt_length(series) -> int:
    return timeseries.pad_length(series).first()["pad_length"]


def _numbered(source: str) -> str:
    return f"(SELECT *, row_number() OVER (PARTITION BY stay_id ORDER BY charttime) - 1 AS slot FROM ({source}))"


@query(
    "pad_mask",
    f"""SELECT g.stay_id, g.slot, {columns(OBSERVED, lambda c: f"coalesce(r.{q(c)}, 0) AS {q(c)}")},
               CAST(r.stay_id IS NOT NULL AS INTEGER) AS input_mask
        FROM {_slots("SELECT * FROM series")} g
        LEFT JOIN {_numbered("SELECT * FROM series")} r ON g.stay_id = r.stay_id AND g.slot = r.slot""",
    ["series"],
)
def _(v: Views):
    padded = timeseries.padded_sequences(v.written_series, OBSERVED, learnt_length(v.written_series))
    slots = F.posexplode(F.arrays_zip(*[F.col(f"`{c}`") for c in (*OBSERVED, "input_mask")])).alias("slot", "row")
    return padded.select("stay_id", slots).select(
        "stay_id", "slot", *[F.col("row")[c].alias(c) for c in (*OBSERVED, "input_mask")]
    )


_WIDTH = 2 * len(OBSERVED) + 1


def _tensor_sql() -> str:
    scaled = [
        f"(r.{q(c)} - s.{q('m' + c)}) / CASE WHEN s.{q('s' + c)} = 0 THEN 1 ELSE s.{q('s' + c)} END" for c in OBSERVED
    ]
    cells = [*scaled, *[f"r.{q('mask_' + c)}" for c in OBSERVED], "r.frac_charttime"]
    shown = ", ".join(f"round(CAST(coalesce({cell}, 0) AS DOUBLE), 6) AS f{i}" for i, cell in enumerate(cells))
    stats = columns(OBSERVED, lambda c: f"avg({q(c)}) AS {q('m' + c)}, stddev_pop({q(c)}) AS {q('s' + c)}")
    return f"""
        WITH prepared AS ({PREPARED}), scaler AS (SELECT {stats} FROM prepared WHERE {IS_TRAIN})
        SELECT g.stay_id, g.slot, {shown}
        FROM {_slots("SELECT * FROM prepared")} g
        LEFT JOIN {_numbered("SELECT * FROM prepared")} r ON g.stay_id = r.stay_id AND g.slot = r.slot, scaler s"""


@query("ts_tensor", _tensor_sql(), ["series"])
def _(v: Views):
    rows = settle(prepared(v))
    scaler = features.fit_scaler(train(rows), OBSERVED)
    tensor = timeseries.sequence_tensor(rows, OBSERVED, scaler, learnt_length(rows))
    return tensor.select("stay_id", F.posexplode("tensor").alias("slot", "row")).select(
        "stay_id", "slot", *[F.round(F.get("row", F.lit(i)), 6).alias(f"f{i}") for i in range(_WIDTH)]
    )
