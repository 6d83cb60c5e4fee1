"""Statistics against brute force and by hand."""

import random

import pytest
from conftest import rows

from stayloom.operators import metrics

PRED = "stay_id long, y_true int, y_prob double, sex string"


def draw(n, seed, ties=20):
    rng = random.Random(seed)
    return [(i, int(rng.random() < 0.3), rng.randrange(ties) / ties, rng.choice("FM")) for i in range(n)]


def brute_auroc(data):
    pos = [p for _, y, p, _ in data if y]
    neg = [p for _, y, p, _ in data if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(data):
    total, found, ap = sum(y for _, y, _, _ in data), 0, 0.0
    for score in sorted({p for _, _, p, _ in data}, reverse=True):
        at = [y for _, y, p, _ in data if p == score]
        above = [y for _, y, p, _ in data if p >= score]
        ap += sum(at) / total * sum(above) / len(above)
        found += sum(at)
    return ap


@pytest.mark.parametrize("ties", [3, 1000])
def test_areas(frame, ties):
    data = draw(120, 1, ties)
    df = frame(PRED, data)
    assert metrics.auroc(df).first()["auroc"] == pytest.approx(brute_auroc(data), abs=1e-6)
    assert metrics.auprc(df).first()["auprc"] == pytest.approx(brute_ap(data), abs=1e-6)


def test_areas_by_group(frame):
    data = draw(150, 2)
    got = dict(rows(metrics.auroc(frame(PRED, data), ["sex"])))
    for sex in "FM":
        assert got[sex] == pytest.approx(brute_auroc([d for d in data if d[3] == sex]), abs=1e-6)


def test_one_class_has_no_area(frame):
    df = frame(PRED, [(1, 1, 0.2, "F"), (2, 1, 0.9, "F")])
    assert rows(metrics.performance(df)) == [(None, 0.5, 0.5, 0.0, None)]


def test_threshold_itself(frame):
    df = frame(PRED, [(1, 1, 0.5, "F"), (2, 0, 0.5, "F"), (3, 0, 0.1, "F")])
    assert rows(metrics.confusion(df), "tp", "fp", "tn", "fn") == [(0, 0, 2, 1)]
    assert rows(metrics.confusion(df, inclusive=True), "tp", "fp", "tn", "fn") == [(1, 1, 1, 0)]


def test_rates_without_denominator_are_null(frame):
    df = frame(PRED, [(1, 1, 0.9, "F")])
    assert rows(metrics.confusion(df), "tpr", "fpr") == [(1.0, None)]


def test_bootstrap_brackets_the_value_and_repeats(frame):
    df = frame(PRED, draw(200, 3))
    first = metrics.bootstrap(df, replicates=40, seed=1)
    got = {r["metric"]: (r["lower"], r["value"], r["upper"]) for r in first.collect()}
    assert set(got) == set(metrics.METRICS)
    for low, value, high in got.values():
        assert low <= value <= high and low < high
    assert rows(metrics.bootstrap(df, replicates=40, seed=1)) == rows(first)
    assert rows(metrics.bootstrap(df, replicates=40, seed=2)) != rows(first)


def test_bootstrap_skips_one_class_draws(frame):
    df = frame(PRED, [(1, 1, 0.9, "F"), (2, 0, 0.1, "F")])
    got = {r["metric"]: (r["lower"], r["upper"]) for r in metrics.bootstrap(df, replicates=30).collect()}
    assert got["auroc"] == (1.0, 1.0)
    assert got["tpr"] == (0.0, 1.0)


def test_bootstrap_draws_are_whole(spark):
    draws = metrics.bootstrap_draws(50, 6, spark).collect()
    assert len(draws) == 300
    assert {d["replicate"] for d in draws} == set(range(6))
    assert all(1 <= d["position"] <= 50 for d in draws)


def test_performance_table_text(frame):
    rows_in = [("m", "Baseline", name, 0.5, 0.25, 0.75) for name in metrics.METRICS]
    df = frame("models string, mix string, metric string, value double, lower double, upper double", rows_in)
    assert metrics.performance_table(df).first()["AUROC"] == "0.5000[0.2500, 0.7500]"


def test_best_model(frame):
    df = frame("model string, y_true int, y_prob double",
               [("a", 1, 0.2), ("a", 0, 0.9), ("b", 1, 0.9), ("b", 0, 0.2), ("c", 1, 0.9), ("c", 0, 0.2)])
    assert rows(metrics.best_model(df), "model") == [("b",)]


def test_fairness(frame):
    data = [(1, 0.9, "F"), (1, 0.1, "F"), (0, 0.9, "F"), (0, 0.1, "F"), (1, 0.9, "M"), (1, 0.9, "M"), (0, 0.1, "M"), (0, 0.5, "M")]
    df = frame("y_true int, y_prob double, sex string", data)
    got = {r["group"]: r for r in metrics.subgroup_metrics(df, ["sex"]).collect()}
    assert (got["F"]["tpr"], got["F"]["fpr"], got["F"]["selection_rate"]) == (0.5, 0.5, 0.5)
    assert (got["M"]["tpr"], got["M"]["fpr"], got["M"]["selection_rate"]) == (1.0, 0.5, 0.75)
    assert rows(metrics.fairness_ratios(df, ["sex"])) == [("sex", 0.666667, 0.5)]
    assert metrics.fairness_report(df, ["sex"]).count() == 2


def test_rate_of_zero_everywhere_has_no_ratio(frame):
    df = frame("y_true int, y_prob double, sex string", [(1, 0.9, "F"), (0, 0.1, "F"), (1, 0.9, "M"), (0, 0.1, "M")])
    assert rows(metrics.fairness_ratios(df, ["sex"])) == [("sex", 1.0, 1.0)]


def test_contributions(frame):
    df = frame("a double, b double, c double", [(1.0, 2.0, -4.0), (3.0, -2.0, 2.0)])
    got = metrics.modality_contribution(df, {"a": 1.0, "b": 1.0, "c": 0.5}, {"x": ["a", "b"], "y": ["c"]})
    assert dict(rows(got)) == {"x": round(4 / 7, 6), "y": round(3 / 7, 6)}
    arrays = df.selectExpr("array(a, b) AS x", "array(c) AS y")
    assert rows(metrics.block_contribution(arrays, {"x": [1.0, 1.0], "y": [0.5]})) == rows(got)
    grouped = metrics.grouped_attribution(df, {"x": ["a", "b"], "y": ["c"]})
    assert rows(grouped) == [(1.0, 2.0), (3.0, -4.0)]
    assert dict(rows(metrics.attribution_contribution(grouped, ["x", "y"]))) == {"x": 2.0, "y": 3.0}


def test_bootstrap_queries_draw_as_often_as_the_operator(spark, monkeypatch):
    import inspect

    from stayloom.driver import ORACLES, QUERIES
    from stayloom.operators import metrics as operators

    seen, draws = [], operators.bootstrap_draws
    monkeypatch.setattr(operators, "bootstrap_draws", lambda n, replicates, *rest: seen.append(replicates) or draws(n, replicates, *rest))
    default = inspect.signature(operators.bootstrap).parameters["replicates"].default
    for name in ("bootstrap_ci", "perf_table"):
        QUERIES[name](spark, "/root/testdata/sf0.001")
        assert f"range({default} * n)" in ORACLES[name]
    assert seen == [default, default] and default == 1000
