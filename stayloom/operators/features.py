"""Feature tables: demographics, scaling, encoding, splits and fusion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayloom.config import MISSING_MARITAL_STATUS, MODALITY_MIXES
from stayloom.functions.values import quoted, regroup
from stayloom.operators.ordered import positions
from stayloom.session import settle

def md5_number(value: Column, digits: int = 7) -> Column:
    """A non-negative number from the first hex digits of the value's md5."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, digits), 16, 10).cast("bigint")


def split_of(key: str = "stay_id", val_from: int = 700, test_from: int = 800) -> Column:
    """'train', 'val' or 'test' by a hash of the key: 70, 10 and 20 percent."""
    bucket = md5_number(F.col(key)) % 1000
    return (
        F.when(bucket < val_from, F.lit("train")).when(bucket < test_from, F.lit("val")).otherwise(F.lit("test"))
    )


def fold_of(key: str = "stay_id", folds: int = 5) -> Column:
    """Cross-validation fold by a hash of the key, unrelated to the split."""
    return (md5_number(F.concat(F.lit("fold:"), F.col(key).cast("string"))) % folds).cast("int")


def union_splits(train: DataFrame, val: DataFrame) -> DataFrame:
    """Rows of both splits, by column name."""
    return train.unionByName(val)


def demographics(tabular: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Race regrouped and unknown marital status named."""
    df = tabular
    if "race" in df.columns:
        df = df.withColumn("race", regroup("race"))
    if "marital_status" in df.columns:
        df = df.fillna(MISSING_MARITAL_STATUS, subset=["marital_status"])
    return df.select(*[quoted(c) for c in (keep or df.columns)])


# --- scaling ------------------------------------------------------------------------------------


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; a constant column is divided by 1."""
    stats = []
    for i, c in enumerate(columns):
        value = quoted(c).cast("double")
        stats += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = train.agg(*stats).first()
    return {
        c: (row[f"m{i}"], row[f"s{i}"] or 1.0)
        for i, c in enumerate(columns)
        if row[f"m{i}"] is not None
    }


def scale(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (quoted(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in scaler.items()})


# --- encoding -----------------------------------------------------------------------------------


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, level, count) of the non-null levels of categorical columns."""
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    levels = texts.unpivot([], [quoted(c) for c in columns], "variable", "level")
    return levels.where("level IS NOT NULL").groupBy("variable", "level").agg(
        F.count(F.lit(1)).alias("count")
    )


def least_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, level, count) of the rarest level of each column; the first name among equals."""
    return least_frequent_of(level_counts(df, columns))


def least_frequent_of(counts: DataFrame) -> DataFrame:
    """`least_frequent` of counted levels."""
    rarest = F.min(F.struct("count", "level")).alias("_rarest")
    return counts.groupBy("variable").agg(rarest).select(
        "variable", F.col("_rarest.level").alias("level"), F.col("_rarest.count").alias("count")
    )


def fit_levels(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, level, position): the levels of the training rows without each column's rarest.

    A dictionary of any size is a table; positions count from 0 by column and then level.
    """
    counts = settle(level_counts(train, columns))
    kept = counts.join(least_frequent_of(counts).select("variable", "level"), ["variable", "level"], "left_anti")
    numbers = F.create_map(*[F.lit(x) for pair in zip(columns, range(len(columns)), strict=True) for x in pair])
    ordered = kept.select("variable", "level", numbers[F.col("variable")].alias("_column"))
    placed = positions(ordered, "_column", ties=["level"])
    return placed.select("variable", "level", (F.col("position") - 1).alias("position"))


def sparse_one_hot(df: DataFrame, levels: DataFrame, columns: Sequence[str], key: str = "stay_id") -> DataFrame:
    """(key, indices): the positions that are 1, rising; a level not seen in training has none.

    Each row sends one small row a column to the dictionary and gets its positions back.
    """
    texts = df.select(quoted(key), *[quoted(c).cast("string").alias(c) for c in columns])
    own = texts.unpivot([quoted(key)], [quoted(c) for c in columns], "variable", "level")
    found = own.join(levels, ["variable", "level"], "left")
    return found.groupBy(key).agg(F.array_sort(F.collect_set("position")).alias("indices"))


def fit_one_hot(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Levels of each column in the training rows without the rarest, which needs no column.

    They become columns, so they have to be as many as a table's columns can be; `fit_levels` and
    `sparse_one_hot` are for more.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in fit_levels(train, columns).orderBy("position").toLocalIterator():
        found[row["variable"]].append(row["level"])
    return found


def one_hot(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by one 0/1 column per level; a level not seen in training gives zeros."""
    encoded = [
        F.when(quoted(c).cast("string") == level, F.lit(1)).otherwise(F.lit(0)).alias(f"{c}_{level}")
        for c, names in levels.items()
        for level in names
    ]
    return df.select(*[quoted(c) for c in df.columns if c not in levels], *encoded)


def demographic_features(
    tabular: DataFrame,
    train: Column,
    numerical: Sequence[str] = ("age",),
    categorical: Sequence[str] = ("gender", "race", "marital_status", "language", "insurance"),
) -> DataFrame:
    """Scaled numbers and encoded categories of all rows, both learnt on the rows where `train` holds."""
    df = demographics(tabular)
    learnt_on = df.where(train)
    scaler, levels = fit_scaler(learnt_on, numerical), fit_one_hot(learnt_on, categorical)
    features = one_hot(scale(df, scaler), levels)
    names = [*numerical, *[f"{c}_{level}" for c in categorical for level in levels[c]]]
    rest = [c for c in df.columns if c not in numerical and c not in categorical]
    return features.select(*[quoted(c) for c in (*rest, *names)])


# --- fusion -------------------------------------------------------------------------------------


@dataclass
class Block:
    """One modality's features: a table of key and array, and the names of the array's elements."""

    data: DataFrame
    names: list[str]


def column_block(df: DataFrame, key: str = "stay_id") -> Block:
    """A block from one column per feature."""
    names = [c for c in df.columns if c != key]
    values = F.array(*[F.coalesce(quoted(c).cast("double"), F.lit(0.0)) for c in names])
    return Block(df.select(key, values.alias("values")), names)


def vector_block(df: DataFrame, vector: str, size: int, prefix: str, key: str = "stay_id") -> Block:
    """A block from an array column of known size; elements are named `<prefix><i>`."""
    values = F.transform(F.col(vector), lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))
    return Block(df.select(key, values.alias("values")), [f"{prefix}{i}" for i in range(size)])


@dataclass
class FusedFeatures:
    """Feature arrays of all blocks and the outcome, one row per stay."""

    data: DataFrame
    names: dict[str, list[str]]
    key: str = "stay_id"

    def columns(self, mix: str) -> list[str]:
        """Feature names of a modality mix, in the order of its vectors."""
        return [c for block in MODALITY_MIXES[mix] if block in self.names for c in self.names[block]]

    def vectors(self, mix: str, label: str) -> DataFrame:
        """Key, y_true and the mix's features as one array."""
        blocks = [b for b in MODALITY_MIXES[mix] if b in self.names]
        return self.data.select(
            self.key, F.col(label).alias("y_true"), F.concat(*[F.col(b) for b in blocks]).alias("features")
        )

    def spread(self) -> DataFrame:
        """One column per feature; meant for narrow blocks."""
        cells = [
            F.get(block, F.lit(i)).alias(name)
            for block, names in self.names.items()
            for i, name in enumerate(names)
        ]
        others = [c for c in self.data.columns if c != self.key and c not in self.names]
        return self.data.select(self.key, *cells, *[quoted(c) for c in others])


def fuse(blocks: Mapping[str, Block], outcome: DataFrame, key: str = "stay_id") -> FusedFeatures:
    """Join the blocks to the rows of the first one by key; a block a stay lacks becomes zeros.

    Blocks stay arrays, so a wide embedding is one column in every join and shuffle.
    """
    data = None
    for name, block in blocks.items():
        part = block.data.withColumnRenamed("values", name)
        data = part if data is None else data.join(part, key, "left")
    zeros = {
        name: F.coalesce(F.col(name), F.array_repeat(F.lit(0.0), len(block.names)))
        for name, block in blocks.items()
    }
    data = data.withColumns(zeros).join(outcome, key, "left")
    return FusedFeatures(data, {name: block.names for name, block in blocks.items()}, key)
