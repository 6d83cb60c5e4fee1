"""Feature tables, fusion and classifiers."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stayloom.operators import features, models
from stayloom.operators.metrics import auroc

PEOPLE = "stay_id long, age int, gender string, race string, marital_status string"


@pytest.fixture
def people(frame):
    return frame(
        PEOPLE,
        [
            (1, 50, "F", "WHITE - OTHER", "MARRIED"), (2, 60, "F", "ASIAN", None),
            (3, 70, "M", None, "SINGLE"), (4, 99, "X", "BLACK", "SINGLE"),
        ],
    )


def test_demographics(people):
    assert rows(features.demographics(people), "stay_id", "race", "marital_status") == [
        (1, "WHITE", "MARRIED"), (2, "ASIAN", "UNKNOWN"), (3, "OTHER", "SINGLE"), (4, "BLACK", "SINGLE")
    ]


def test_least_frequent_breaks_ties_by_name(people):
    got = features.least_frequent(people, ["gender", "marital_status"])
    assert rows(got) == [("gender", "M", 1), ("marital_status", "MARRIED", 1)]


def test_demographic_features_learn_on_train_only(people):
    got = features.demographic_features(people, F.col("stay_id") <= 3, ["age"], ["gender"])
    assert got.columns[-2:] == ["age", "gender_F"]
    values = {r["stay_id"]: (round(r["age"], 4), r["gender_F"]) for r in got.collect()}
    assert values == {1: (-1.2247, 1), 2: (0.0, 1), 3: (1.2247, 0), 4: (4.7765, 0)}


def test_constant_column_is_divided_by_one(frame):
    df = frame("x double", [(3.0,), (3.0,)])
    assert features.fit_scaler(df, ["x"]) == {"x": (3.0, 1.0)}


def test_split_shares(spark):
    df = spark.range(20000).select(features.split_of("id").alias("s"), features.fold_of("id").alias("f"))
    shares = {r["s"]: r["count"] / 20000 for r in df.groupBy("s").count().collect()}
    assert shares == pytest.approx({"train": 0.7, "val": 0.1, "test": 0.2}, abs=0.02)
    assert sorted(r["f"] for r in df.select("f").distinct().collect()) == [0, 1, 2, 3, 4]


def test_fuse_fills_missing_blocks_with_zeros(frame):
    blocks = {
        "tabular": features.column_block(frame("stay_id long, age double", [(1, 0.5), (2, None)])),
        "time_series": features.column_block(frame("stay_id long, hr double", [(1, 9.0)])),
        "image": features.vector_block(frame("stay_id long, e array<float>", [(2, [1.0, None])]), "e", 2, "img_"),
        "text": features.column_block(frame("stay_id long, t double", [(1, 4.0)])),
    }
    fused = features.fuse(blocks, frame("stay_id long, died int", [(1, 1), (2, 0)]))
    assert fused.columns("Baseline+Image") == ["age", "hr", "img_0", "img_1"]
    assert rows(fused.vectors("Baseline+Image+Text", "died")) == [
        (1, 1, [0.5, 9.0, 0.0, 0.0, 4.0]), (2, 0, [0.0, 0.0, 1.0, 0.0, 0.0])
    ]
    assert fused.spread().columns == ["stay_id", "age", "hr", "img_0", "img_1", "t", "died"]


def test_logistic_grid_tries_no_penalty_once():
    assert len(models.logistic_search(100).grid) == 3 * (4 + 4 + 1)
    assert len(models.tree_search().grid) == 3 * 3 * 3 * 2


def test_classifier_finds_the_signal(frame):
    rng = random.Random(5)
    data = []
    for i in range(400):
        x = rng.gauss(0, 1)
        data.append((i, int(x + rng.gauss(0, 0.3) > 0), [x, rng.gauss(0, 1)]))
    df = frame("stay_id long, y_true int, features array<double>", data)
    search = models.logistic_search(280, strengths=[1.0], penalties=["l2"], iterations=[100])
    scores, model = models.fit_predict(df, search=search)
    assert auroc(scores).first()["auroc"] > 0.9
    assert scores.count() == df.where(features.split_of("stay_id") == "test").count()
    assert len(model.tried) == 1 and model.settings["maxIter"] == 100


def signal(frame, rows=400, seed=5):
    rng, data = random.Random(seed), []
    for i in range(rows):
        x = [rng.gauss(0, 1) for _ in range(4)]
        data.append((i, int(x[0] * x[1] + x[2] + rng.gauss(0, 0.5) > 0), x))
    return models.prepare(frame("stay_id long, y_true int, features array<double>", data))


def scored(model, rows):
    return [r["y_prob"] for r in models.predict(model, rows).orderBy("stay_id").collect()]


def test_first_trees_are_the_model_of_fewer_iterations(frame):
    rows = signal(frame)
    make = models.tree_search().estimator
    setting = {"maxDepth": 3, "stepSize": 0.1, "minInstancesPerNode": 20}
    long, short = (models._path_models(make, setting, [n], rows)[n] for n in (12, 5))
    cut = models.first_trees(long, 5)
    assert cut.getNumTrees == 5 and scored(cut, rows) == pytest.approx(scored(short, rows))
    assert models.first_trees(long, 12) is long and scored(long, rows) != pytest.approx(scored(short, rows))


def test_halving_finds_the_winner_of_the_full_grid(frame):
    rows = signal(frame, 300)
    grid = {"depths": [2, 5, 10], "steps": [0.02, 0.3], "leaf_rows": [5, 120], "counts": [4, 20]}
    full = models.fit(rows, models.tree_search(**grid, rounds=models.ALL), folds=3)
    halved = models.fit(rows, models.tree_search(**grid), folds=3)
    assert len(full.tried) == 3 * 2 * 2 * 2
    last = max(turn for turn, *_ in halved.tried)
    assert len([t for t in halved.tried if t[0] == 0]) == 12 and len([t for t in halved.tried if t[0] == last]) == 2
    assert halved.settings == full.settings and halved.auroc == pytest.approx(full.auroc)
    assert full.auroc == pytest.approx(max(t[3] for t in full.tried))


def test_the_last_path_left_is_fitted_on_all_rows_beside_the_folds(frame, monkeypatch):
    data = [(i, [float(i % 7), float(i % 3)], i % 7 > 3) for i in range(200)]
    df = frame("stay_id long, features array<double>, y_true boolean", data).withColumn("y_true", F.col("y_true").cast("int"))
    training = models.prepare(df).where("split <> 'test'")
    seen, one = [], models._path_models
    monkeypatch.setattr(models, "_path_models", lambda e, s, limits, rows: seen.append((rows is training, limits)) or one(e, s, limits, rows))
    search = models.tree_search([2], [0.1], [5], [2, 4], rounds=models.ALL)
    found = models.fit(training, search, folds=2)
    assert [limits for whole, limits in seen if whole] == [[2, 4]] and len(seen) == 3
    assert found.model.getNumTrees == found.settings["maxIter"]


def test_depths_that_are_not_reached_score_alike(frame):
    """Twelve fits in full give what fits from the deepest down give."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rows = signal(frame, 200)
    search = models.tree_search(depths=[1, 4, 9], steps=[0.1], leaf_rows=[25], counts=[6], rounds=models.ALL)
    found = models.fit(rows, search, folds=2)
    measure = BinaryClassificationEvaluator(labelCol="y_true")
    for _, setting, limit, mean in found.tried:
        each = []
        for k in (0, 1):
            model = models._path_models(search.estimator, setting, [limit], rows.where(F.col("fold") != k))[limit]
            each.append(measure.evaluate(model.transform(rows.where(F.col("fold") == k))))
        assert mean == pytest.approx(sum(each) / 2)


def test_a_converged_regression_serves_all_limits(frame):
    rows = signal(frame)
    search = models.logistic_search(400, strengths=[1.0], penalties=["l2"])
    found = models._path_models(search.estimator, search.paths[0].settings, [2, 100, 500], rows)
    assert found[100] is found[500] and found[2] is not found[500]
    for limit in (2, 100):
        own = search.estimator.fit(rows, {**search.grid[0], search.estimator.maxIter: limit})
        assert found[limit].coefficients.toArray() == pytest.approx(own.coefficients.toArray())


@pytest.mark.parametrize("kind", ["LR", "GBT"])
def test_models_are_kept_and_read_back(spark, frame, tmp_path, kind):
    rows = signal(frame)
    search = (
        models.logistic_search(400, strengths=[1.0], penalties=["l2"], iterations=[50])
        if kind == "LR" else models.tree_search([3], [0.1], [20], [3], rounds=models.ALL)
    )
    made = []

    def make():
        made.append(models.fit(rows, search, folds=2))
        return made[0]

    store, blocks = models.ModelStore(spark, str(tmp_path)), {"tabular": ["a", "b"], "image": ["c", "d"]}
    for _ in range(2):
        kept = store.fit_or_load("one", make, blocks)
        assert scored(kept, rows) == pytest.approx(scored(made[0].model, rows))
    assert len(made) == 1
    table = store.coefficients("one").collect()
    assert len(table) == (5 if kind == "LR" else 4) and list(store.block_coefficients("one")) == ["image", "tabular"]
    if kind == "LR":
        assert store.block_coefficients("one")["image"] == pytest.approx(made[0].model.coefficients.toArray()[2:])
        assert [r["coefficient"] for r in table if r["block"] == ""] == pytest.approx([made[0].model.intercept])
    assert {r["setting"] for r in store.settings("one").collect()} >= {"maxIter", "auroc"}


def test_classifier_queries_take_the_whole_grid_and_fused_features(spark, monkeypatch, tmp_path):
    from stayloom.driver import QUERIES

    seen = []

    def fit(training, search, *rest, **options):
        seen.append((len(search.grid), training.select("vector").first()[0].size))
        one = search.estimator.fit(training, {search.estimator.maxIter: 1})
        return models.Found(one, search.paths[0].settings, 0.5)

    monkeypatch.setattr(models, "fit", fit)
    monkeypatch.setattr("stayloom.driver.features._store", lambda v: models.ModelStore(spark, str(tmp_path)))
    for name in ("lr_predict", "gbt_predict", "lr_predict_range", "gbt_predict_range", "lr_contribution"):
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert got.count() > 0
        if "range" not in name and "contribution" not in name:
            assert got.columns == ["stay_id", "y_true", "y_prob"]
    grids = len(models.logistic_search(1).grid), len(models.tree_search().grid)
    assert seen == [(grids[0], 77), (grids[1], 77)] and grids == (27, 54)


def test_classifiers_are_chosen_by_cross_validation_of_the_whole_grid(spark, frame, monkeypatch, tmp_path):
    """Every setting is scored on every fold with all its trees: no round leaves settings out before that."""
    from stayloom.driver import QUERIES

    seen = []

    def fit(training, search, *rest, **options):
        seen.append(search)
        return models.Found(search.estimator.fit(training, {search.estimator.maxIter: 1}), search.paths[0].settings, 0.5)

    monkeypatch.setattr(models, "fit", fit)
    monkeypatch.setattr("stayloom.driver.features._store", lambda v: models.ModelStore(spark, str(tmp_path)))
    QUERIES["gbt_predict"](spark, "/root/testdata/sf0.001")
    data = [(i, [float(i % 7), float(i % 3)], int(i % 7 > 3)) for i in range(200)]
    models.fit_predict(frame("stay_id long, features array<double>, y_true int", data), "GBT")
    assert len(seen) == 2 and all(list(s.rounds) == [models.Round(1.0, 5, 0.0)] and len(s.grid) == 54 for s in seen)


def test_logistic_optimum(spark):
    """The gradient of the penalised loss is near zero at what the search's estimator finds."""
    import math

    draw = random.Random(3)
    points = [(i, [draw.gauss(0, 1), draw.gauss(0, 1)]) for i in range(300)]
    data = [(i, int(x[0] - x[1] / 2 + draw.gauss(0, 1) > 0), x) for i, x in points]
    table = models.prepare(spark.createDataFrame(data, "stay_id bigint, y_true int, features array<double>"))
    search = models.logistic_search(300, strengths=[1.0], penalties=["l2"], iterations=[500])
    fitted = search.estimator.fit(table, search.grid[0])
    w, b = fitted.coefficients.toArray(), fitted.intercept
    errors = [1 / (1 + math.exp(-(w[0] * x[0] + w[1] * x[1] + b))) - y for _, y, x in data]
    assert abs(sum(errors)) / 300 < 1e-3
    for k in (0, 1):
        assert abs(sum(e * x[k] for e, (_, _, x) in zip(errors, data)) / 300 + w[k] / 300) < 1e-3


def test_more_than_a_thousand_levels(frame):
    people = frame("stay_id long, ward string, bed string", [(i, f"w{i % 1500:04d}", "x" if i % 3 else None) for i in range(3200)])
    levels = features.fit_levels(people, ["ward", "bed"])
    table = {(r["variable"], r["level"]): r["position"] for r in levels.collect()}
    # The rarest ward, w0200, and the only bed have no position.
    assert len(table) == 1499 and ("ward", "w0200") not in table and sorted(table.values()) == list(range(1499))
    assert [level for (_, level), _ in sorted(table.items(), key=lambda x: x[1])] == sorted(level for _, level in table)
    new = frame("stay_id long, ward string, bed string", [(1, "w0007", "x"), (2, "w0200", None), (3, "none", "y"), (4, None, None)])
    got = rows(features.sparse_one_hot(new, levels, ["ward", "bed"]), "stay_id", "indices")
    assert got == [(1, [7]), (2, []), (3, []), (4, [])]
    assert len(features.fit_one_hot(people, ["ward"])["ward"]) == 1499
