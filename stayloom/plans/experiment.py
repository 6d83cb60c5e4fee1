"""From the training set to features, predictions, texts and evaluation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayloom.config import (
    AGE_CUTOFFS,
    MODALITY_MIXES,
    TABULAR_VARIABLES,
    VITAL_BOUNDS,
    VITAL_SIGNS,
)
from stayloom.functions.values import band
from stayloom.operators import features, metrics, models, notes, profiles, timeseries
from stayloom.operators.joins import restrict
from stayloom.session import settle

IS_TRAIN = "train"


def demographic_block(
    tabular: DataFrame,
    numerical: Sequence[str] = ("age",),
    categorical: Sequence[str] = ("gender", "race", "marital_status", "language", "insurance"),
) -> DataFrame:
    """Scaled and encoded demographics of every stay, learnt on the training split."""
    kept = [c for c in TABULAR_VARIABLES if c in tabular.columns]
    return features.demographic_features(
        tabular.select(*kept), features.split_of("stay_id") == IS_TRAIN, numerical, categorical
    ).drop("subject_id", "hadm_id")


def fixed_interval_block(
    series: DataFrame,
    stays: DataFrame,
    total_length: int = 24,
    bin_length: int = 1,
    method: str = "forward",
    variables: Sequence[str] = VITAL_SIGNS,
    bounds: Mapping[str, Sequence[float]] = VITAL_BOUNDS,
    medians_from_train: bool = True,
) -> DataFrame:
    """Binned vital signs of every stay, one column per variable and bin."""
    learnt_on = stays.where(features.split_of("stay_id") == IS_TRAIN) if medians_from_train else None
    return timeseries.fixed_interval_features(
        series, stays, variables, bounds, total_length, bin_length, method, learnt_on
    )


@dataclass
class Sequences:
    """Padded sequences of every stay with rows, and their length."""

    data: DataFrame
    length: int


def sequences(
    series: DataFrame,
    total_length: int = 24,
    method: str = "forward",
    variables: Sequence[str] = VITAL_SIGNS,
    bounds: Mapping[str, Sequence[float]] = VITAL_BOUNDS,
    scaled: bool = True,
) -> Sequences:
    """Model input sequences: scaled values with masks and times, or plain values with a mask.

    Medians, scaling and the padded length (the 99.9 percentile) are learnt on the training split.
    """
    train = series.where(features.split_of("stay_id") == IS_TRAIN)
    medians = {
        r["variable"]: r["median"]
        for r in timeseries.global_medians(train, variables, total_length, bounds).collect()
    }
    prepared = settle(timeseries.preprocess(series, variables, total_length, bounds, medians, method))
    learnt_on = prepared.where(features.split_of("stay_id") == IS_TRAIN)
    length = timeseries.pad_length(learnt_on).first()["pad_length"]
    if scaled:
        scaler = features.fit_scaler(learnt_on, variables)
        return Sequences(timeseries.sequence_tensor(prepared, variables, scaler, length), length)
    return Sequences(timeseries.padded_sequences(prepared, variables, length), length)


def note_texts(radiology: DataFrame, numbered: bool = False) -> DataFrame:
    """One text per stay from its radiology notes, as input of a text encoder."""
    return notes.numbered_texts(radiology) if numbered else notes.joined_texts(radiology)


def scaled_block(block: DataFrame, key: str = "stay_id") -> DataFrame:
    """Columns scaled with the mean and deviation of the training split."""
    columns = [c for c in block.columns if c != key]
    scaler = features.fit_scaler(block.where(features.split_of(key) == IS_TRAIN), columns)
    return features.scale(block, scaler)


def predictions(
    fused: features.FusedFeatures, outcome: str, models_name: str, kind: str = "LR",
    mixes: Sequence[str] = tuple(MODALITY_MIXES), search: models.Search | None = None,
    store: models.ModelStore | None = None,
) -> DataFrame:
    """Test-split scores of a classifier per modality mix, as (models, mix, stay_id, y_true, y_prob).

    With a `store` each mix's model is kept there under the mix's name.
    """
    parts = []
    for mix in mixes:
        scores, found = models.fit_predict(fused.vectors(mix, outcome), kind, search)
        if store:
            store.save(mix, found, {b: fused.names[b] for b in MODALITY_MIXES[mix] if b in fused.names})
        parts.append(settle(scores).select(F.lit(models_name).alias("models"), F.lit(mix).alias("mix"), "*"))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


def contributions(
    fused: features.FusedFeatures, store: models.ModelStore, mixes: Sequence[str] = tuple(MODALITY_MIXES)
) -> DataFrame:
    """(mix, modality, contribution) of the kept models' coefficients over the fused features."""
    parts = [
        metrics.block_contribution(fused.data, store.block_coefficients(mix)).select(F.lit(mix).alias("mix"), "*")
        for mix in mixes
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


def performance(scores: DataFrame, replicates: int = 1000, alpha: float = 0.95, seed: int = 0) -> DataFrame:
    """Statistics with bootstrap intervals per model and mix, formatted."""
    by = ["models", "mix"]
    return metrics.performance_table(
        metrics.bootstrap(scores, by, replicates=replicates, alpha=alpha, seed=seed), by
    )


def fairness(
    scores: DataFrame, tabular: DataFrame, sensitive: Sequence[str] = ("gender", "race", "age_group"),
    cutoffs: Sequence[int] = AGE_CUTOFFS,
) -> DataFrame:
    """Subgroup statistics and ratios for one mix's scores by demographic groups."""
    people = features.demographics(tabular).withColumn("age_group", band("age", cutoffs))
    joined = scores.join(people.select("stay_id", *sensitive), "stay_id")
    return metrics.fairness_report(joined, sensitive)


def qa_dataset(
    tabular: DataFrame, series: DataFrame, images: DataFrame, radiology: DataFrame, split: str | None = "test"
) -> DataFrame:
    """Question records of the stays of one split (all stays when None)."""
    stays = tabular if split is None else tabular.where(features.split_of("stay_id") == split)
    keys = stays.select("stay_id")
    series, images, radiology = (restrict(df, keys, ["stay_id"]) for df in (series, images, radiology))
    profile = profiles.patient_profiles(stays, series, images, radiology)
    return profiles.qa_records(profile, images, stays.select("stay_id", "hospital_expire_flag", "los_binary"))
