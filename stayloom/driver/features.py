"""Feature tables and classifiers over the derived tables."""

from __future__ import annotations

import hashlib

from pyspark.sql import Window
from pyspark.sql import functions as F

from stayloom.config import MODALITY_MIXES, RACE_GROUPS
from stayloom.driver.registry import query
from stayloom.driver.selection import base
from stayloom.driver.series import SPLIT_NUMBER
from stayloom.driver.views import OBSERVED, Views
from stayloom.functions.values import regroup
from stayloom.operators import features, metrics, models
from stayloom.operators.outcomes import los_binary
from stayloom.session import shared_folder

_GROUPS = " ".join(f"WHEN contains(race, '{g}') THEN '{g}'" for g in RACE_GROUPS)
REGROUPED = f"CASE {_GROUPS} ELSE 'OTHER' END"
CATEGORIES = ["gender", "race", "marital_status", "language", "insurance"]
NUMBER = SPLIT_NUMBER.format(key="stay_id")
SPLIT = f"CASE WHEN {NUMBER} < 700 THEN 'train' WHEN {NUMBER} < 800 THEN 'val' ELSE 'test' END"

DEMOGRAPHICS = f"""
    SELECT subject_id, hadm_id, stay_id, CAST(age AS INTEGER) AS age, gender, {REGROUPED} AS race,
           coalesce(marital_status, 'UNKNOWN') AS marital_status, language, insurance
    FROM base"""
COLUMNS = ["subject_id", "hadm_id", "stay_id", "age", *CATEGORIES]
TRAIN = f"SELECT * FROM ({DEMOGRAPHICS}) WHERE {NUMBER} < 700"


def demographics(v: Views):
    return features.demographics(base(v).select(*COLUMNS))


def is_train():
    return features.split_of("stay_id") == "train"


@query("regroup_category", f"SELECT hadm_id, race, {REGROUPED} AS race_group FROM admissions", ["admissions"])
def _(v: Views):
    return v["admissions"].select("hadm_id", "race", regroup("race").alias("race_group"))


@query("demographics", DEMOGRAPHICS, ["base"])
def _(v: Views):
    return demographics(v)


def _levels(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {c} AS level, count(*) AS n FROM ({source}) WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORIES
    )


@query(
    "least_frequent",
    f"""SELECT variable, level, n AS count FROM
            (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n, level) AS r FROM ({_levels(DEMOGRAPHICS)}))
        WHERE r = 1""",
    ["base"],
)
def _(v: Views):
    return features.least_frequent(demographics(v), CATEGORIES)


@query(
    "standardize",
    f"""SELECT d.stay_id, round((d.age - t.m) / t.s, 6) AS age
        FROM ({DEMOGRAPHICS}) d, (SELECT avg(age) AS m, stddev_pop(age) AS s FROM ({TRAIN})) t""",
    ["base"],
)
def _(v: Views):
    df = demographics(v)
    scaled = features.scale(df, features.fit_scaler(df.where(is_train()), ["age"]))
    return scaled.select("stay_id", F.round("age", 6).alias("age"))


@query(
    "one_hot",
    f"""WITH kept AS (SELECT variable, level FROM
                (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n, level) AS r FROM ({_levels(TRAIN)}))
             WHERE r > 1),
             own AS ({" UNION ALL ".join(f"SELECT stay_id, '{c}' AS variable, {c} AS level FROM ({DEMOGRAPHICS})" for c in CATEGORIES)})
        SELECT own.stay_id, kept.variable || '_' || kept.level AS feature,
               CASE WHEN own.level = kept.level THEN 1 ELSE 0 END AS value
        FROM own JOIN kept ON own.variable = kept.variable""",
    ["base"],
)
def _(v: Views):
    """Encoded categories in long form, since the columns depend on the levels found."""
    encoded = features.demographic_features(base(v).select(*COLUMNS), is_train(), ["age"], CATEGORIES)
    names = [c for c in encoded.columns if c not in ("subject_id", "hadm_id", "stay_id", "age")]
    return encoded.unpivot(["stay_id"], [F.col(f"`{c}`") for c in names], "feature", "value")


SPARSE = ["subject_id", "insurance", "race"]


@query(
    "one_hot_sparse",
    f"""WITH people AS (SELECT stay_id, CAST(subject_id AS VARCHAR) AS subject_id, insurance, race FROM ({DEMOGRAPHICS})),
             levels AS ({" UNION ALL ".join(f"SELECT {i} AS c, {c} AS level, count(*) AS n FROM people WHERE {NUMBER} < 700 GROUP BY {c}" for i, c in enumerate(SPARSE))}),
             kept AS (SELECT c, level, row_number() OVER (ORDER BY c, level) - 1 AS position FROM
                 (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n, level) AS r FROM levels) WHERE r > 1),
             own AS ({" UNION ALL ".join(f"SELECT stay_id, {i} AS c, {c} AS level FROM people" for i, c in enumerate(SPARSE))})
        SELECT stay_id, coalesce(string_agg(CAST(position AS VARCHAR), ' ' ORDER BY position), '') AS indices
        FROM own LEFT JOIN kept USING (c, level) GROUP BY stay_id""",
    ["base"],
)
def _(v: Views):
    """Positions of each stay's categories, with every subject a category: the dictionary is a table."""
    people = demographics(v)
    levels = features.fit_levels(people.where(is_train()), SPARSE)
    found = features.sparse_one_hot(people, levels, SPARSE)
    return found.select("stay_id", F.array_join(F.col("indices").cast("array<string>"), " ").alias("indices"))


@query("hash_split", f"SELECT stay_id, {SPLIT} AS split FROM icustays", ["icustays"])
def _(v: Views):
    return v["icustays"].select("stay_id", features.split_of("stay_id").alias("split"))


@query("union_splits", f"SELECT stay_id, los FROM icustays WHERE {NUMBER} < 800", ["icustays"])
def _(v: Views):
    rows = v["icustays"].select("stay_id", "los", features.split_of("stay_id").alias("split"))
    train, val = (rows.where(F.col("split") == s).drop("split") for s in ("train", "val"))
    return features.union_splits(train, val)


# --- fusion -------------------------------------------------------------------------------------

_SERIES = OBSERVED
_SIZE = 64
FUSED = f"""
    SELECT b.stay_id, CAST(b.age AS DOUBLE) AS age, CAST(b.los AS DOUBLE) AS los,
           {", ".join(f'coalesce(t."{c}", 0) AS "{c}"' for c in _SERIES)},
           {", ".join(f"coalesce(CAST(e.embedding[{i + 1}] AS DOUBLE), 0) AS img_{i}" for i in range(_SIZE))},
           CAST(coalesce(l.quality, 0) AS DOUBLE) AS txt_0, CAST(coalesce(l.toxic, 0) AS DOUBLE) AS txt_1,
           CASE WHEN b.los > 3 THEN 1 ELSE 0 END AS los_binary
    FROM base b
    LEFT JOIN (SELECT stay_id, {", ".join(f'round(avg("{c}"), 6) AS "{c}"' for c in _SERIES)} FROM series GROUP BY stay_id) t
        ON b.stay_id = t.stay_id
    LEFT JOIN embeddings e ON b.stay_id = e.vec_id
    LEFT JOIN labels l ON b.stay_id = l.doc_id"""


def source_blocks(v: Views) -> dict[str, features.Block]:
    rows = base(v)
    means = v.series.groupBy("stay_id").agg(*[F.round(F.avg(f"`{c}`"), 6).alias(c) for c in _SERIES])
    vectors = v["embeddings"].select(F.col("vec_id").alias("stay_id"), "embedding")
    text = v["labels"].select(
        F.col("doc_id").alias("stay_id"), F.col("quality").alias("txt_0"), F.col("toxic").alias("txt_1")
    )
    return {
        "tabular": features.column_block(rows.select("stay_id", "age", "los")),
        "time_series": features.column_block(means),
        "image": features.vector_block(vectors, "embedding", _SIZE, "img_"),
        "text": features.column_block(text),
    }


def fused(v: Views) -> features.FusedFeatures:
    return features.fuse(source_blocks(v), base(v).select("stay_id", los_binary(3).alias("los_binary")))


@query("feature_fusion", FUSED, ["base", "series"])
def _(v: Views):
    return fused(v).spread()


def _mix_sql() -> str:
    blocks = {
        "tabular": ["age", "los"],
        "time_series": [f'"{c}"' for c in _SERIES],
        "image": [f"img_{i}" for i in range(_SIZE)],
        "text": ["txt_0", "txt_1"],
    }
    parts = []
    for mix, names in MODALITY_MIXES.items():
        found = [c for n in names for c in blocks[n]]
        parts.append(
            f"SELECT stay_id, '{mix}' AS mix, los_binary AS y_true, {len(found)} AS n_features, "
            f"round({' + '.join(found)}, 6) AS feature_sum FROM fused"
        )
    return f"WITH fused AS ({FUSED}) " + " UNION ALL ".join(parts)


@query("modality_mixes", _mix_sql(), ["base", "series"])
def _(v: Views):
    whole = fused(v)
    parts = []
    for mix in MODALITY_MIXES:
        total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x)
        parts.append(
            whole.vectors(mix, "los_binary").select(
                "stay_id", F.lit(mix).alias("mix"), "y_true", F.size("features").alias("n_features"),
                F.round(total, 6).alias("feature_sum"),
            )
        )
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


# --- classifiers --------------------------------------------------------------------------------


def labelled(v: Views) -> features.FusedFeatures:
    """Labelled documents with the fused features of all modalities; no label is a feature."""
    languages = ["de", "en", "es", "fr"]
    df = v["labels"].join(v["documents"].select("doc_id", "lang", "n_chars", "source"), "doc_id")
    text = df.select(
        F.col("doc_id").alias("stay_id"), F.log1p("n_chars").alias("txt_chars"),
        *[(F.col("lang") == name).cast("double").alias(f"txt_{name}") for name in languages],
        F.length("source").cast("double").alias("txt_source"),
    )
    blocks = {"text": features.column_block(text)} | {k: b for k, b in source_blocks(v).items() if k != "text"}
    outcome = df.select(F.col("doc_id").alias("stay_id"), F.col("quality").alias("label"))
    return features.fuse(blocks, outcome)


MIX = "Baseline+Image+Text"


#: What SQL can know of learnt scores: the rows of the test split, their labels, and the range of a probability.
_SCORED = f"""SELECT stay_id, y_true, TRUE AS probable
    FROM (SELECT doc_id AS stay_id, CAST(quality AS INTEGER) AS y_true FROM labels JOIN documents USING (doc_id))
    WHERE ({SPLIT}) = 'test'"""


def _in_range(predictions):
    return predictions.select("stay_id", "y_true", F.col("y_prob").between(0, 1).alias("probable"))


def _store(v: Views) -> models.ModelStore:
    """Where this session keeps the models of a folder's tables, for all queries that need them."""
    place = hashlib.md5(f"{v.spark.sparkContext.applicationId} {v.folder}".encode()).hexdigest()
    return models.ModelStore(v.spark, f"{shared_folder(v.spark)}/models-{place}")


def _fitted(v: Views, kind: str):
    """The model of a kind, kept or fitted over the whole grid, and the rows it is for."""
    whole = labelled(v)
    rows = models.prepare(whole.vectors(MIX, "label"))
    training = rows.where("split <> 'test'")

    def make() -> models.Found:
        search = models.logistic_search(training.count()) if kind == "LR" else models.tree_search(rounds=models.ALL)
        return models.fit(training, search)

    blocks = {b: whole.names[b] for b in MODALITY_MIXES[MIX]}
    return _store(v).fit_or_load(kind, make, blocks), rows.where("split = 'test'")


def _logistic(v: Views):
    return models.predict(*_fitted(v, "LR"))


def _trees(v: Views):
    return models.predict(*_fitted(v, "GBT"))


@query("lr_predict")
def _(v: Views):
    """Cross-validated logistic regression scores of the test split, over the whole grid."""
    return _logistic(v)


@query("gbt_predict")
def _(v: Views):
    """Cross-validated boosted-tree scores of the test split, over the whole grid."""
    return _trees(v)


@query("lr_predict_range", _SCORED)
def _(v: Views):
    return _in_range(_logistic(v))


@query("gbt_predict_range", _SCORED)
def _(v: Views):
    return _in_range(_trees(v))


@query(
    "lr_contribution",
    " UNION ALL ".join(f"SELECT '{b}' AS modality, TRUE AS share, 1.0E0 AS total" for b in MODALITY_MIXES[MIX]),
)
def _(v: Views):
    """Contribution of each modality under the kept logistic regression: shares that add up to 1."""
    _fitted(v, "LR")
    shares = metrics.block_contribution(labelled(v).data, _store(v).block_coefficients("LR"), digits=9)
    whole = F.sum("contribution").over(Window.partitionBy())  # one row a modality
    return shares.select("modality", F.col("contribution").between(0, 1).alias("share"), F.round(whole, 6).alias("total"))
