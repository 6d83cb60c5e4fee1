"""Sliced order-dependent operators against brute force, with and without slices."""

import math
import random
import statistics

import pytest
from conftest import rows

from stayloom.operators import ordered

CUTS = [None, []]  # None: many slices (two rows each); []: one slice


@pytest.fixture
def skewed(frame):
    """One key owns most rows."""
    rng = random.Random(1)
    data = [("hot", float(i), rng.choice([None, float(i)])) for i in rng.sample(range(60), 60)]
    data += [(f"k{k}", float(i), rng.choice([None, float(k)])) for k in range(5) for i in range(4)]
    return data, frame("k string, t double, v double", data)


def by_key(data):
    groups = {}
    for k, t, v in data:
        groups.setdefault(k, []).append((t, v))
    return {k: sorted(g, key=lambda x: x[0]) for k, g in groups.items()}


def test_cut_points_follow_the_row_count(spark):
    df = spark.range(100).withColumnRenamed("id", "x")
    assert len(ordered.cut_points(df, "x")) > 30
    assert ordered.cut_points(df.limit(2), "x") == []
    sizes = ordered.with_slice(df, "x", ordered.cut_points(df, "x")).groupBy("_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 4


@pytest.mark.parametrize("cuts", CUTS)
@pytest.mark.parametrize("descending", [False, True])
def test_running_sum(frame, cuts, descending):
    rng = random.Random(2)
    data = [(rng.choice("aab"), rng.randrange(12), rng.randrange(5)) for _ in range(80)]
    got = ordered.running_sum(frame("k string, t int, n long", data), ["k"], "t", ["n"], descending, cuts)
    want = []
    for key in "ab":
        times = sorted({t for k, t, _ in data if k == key})
        for t in times:
            same = sum(n for k, u, n in data if k == key and u == t)
            upto = sum(n for k, u, n in data if k == key and (u >= t if descending else u <= t))
            want.append((key, t, same, upto, sum(n for k, _, n in data if k == key)))
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("cuts", CUTS)
def test_positions_number_nulls_last(frame, cuts):
    data = [("a", 3, "x"), ("a", None, "y"), ("a", 1, "z"), ("a", 3, "w"), ("b", None, "q")]
    got = ordered.positions(frame("k string, t int, name string", data), "t", ["k"], ["name"], cuts=cuts)
    assert rows(got, "name", "position") == [("q", 1), ("w", 2), ("x", 3), ("y", 4), ("z", 1)]


def test_positions_without_key(frame):
    df = frame("id long", [(i,) for i in random.Random(3).sample(range(0, 500, 5), 100)])
    got = ordered.positions(df, "id").collect()
    assert sorted((r["id"], r["position"]) for r in got) == [(5 * i, i + 1) for i in range(100)]


@pytest.mark.parametrize("cuts", CUTS)
def test_next_value(skewed, cuts):
    data, df = skewed
    want = []
    for k, group in by_key(data).items():
        times = sorted({t for t, _ in group})
        want += [(k, t, n) for t, n in zip(times, times[1:] + [None])]
    assert rows(ordered.next_value(df, ["k"], "t", "n", cuts)) == sorted(want, key=repr)


@pytest.mark.parametrize("cuts", CUTS)
@pytest.mark.parametrize("backward", [False, True])
def test_fill_gaps(skewed, cuts, backward):
    data, df = skewed
    want = []
    for k, group in by_key(data).items():
        values, last = [], None
        for _, v in group:
            last = v if v is not None else last
            values.append(last)
        if backward:
            first = next((v for v in values if v is not None), None)
            values = [first if v is None else v for v in values]
        want += [(k, t, v) for (t, _), v in zip(group, values)]
    assert rows(ordered.fill_gaps(df, ["k"], "t", ["v"], backward, cuts)) == sorted(want, key=repr)


def test_exact_quantiles(skewed):
    data, df = skewed
    got = {r["k"]: r for r in ordered.exact_quantiles(df, ["k"], "t", {"m": 0.5, "q": 0.9}).collect()}
    for k, group in by_key(data).items():
        times = [t for t, _ in group]
        assert got[k]["m"] == statistics.median(times)
        rank = 0.9 * (len(times) - 1)
        low, high = times[math.floor(rank)], times[math.ceil(rank)]
        assert got[k]["q"] == pytest.approx(low + (high - low) * (rank - math.floor(rank)))


def test_quantile_of_nothing_is_empty(frame):
    assert ordered.exact_quantiles(frame("k string, t double", []), ["k"], "t", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_slices_change_nothing_also_with_nulls(spark, frame, seed):
    """Two rows per slice and one slice of all rows: the same, with NULL keys and order values."""
    rng = random.Random(seed)
    some = lambda x: None if rng.random() < 0.25 else x
    data = [(some(rng.choice("ab")), some(float(rng.randrange(12))), some(rng.randrange(5)), i) for i in range(60)]
    data.append(("a", float("nan"), 1, 60))
    df = frame("k string, t double, n long, id long", data)
    once = frame("k string, t double, n long", list({(k, t): (k, t, n) for k, t, n, _ in data}.values()))
    ways = {
        "sum": lambda cuts: ordered.running_sum(df, ["k"], "t", ["n"], False, cuts),
        "falling": lambda cuts: ordered.running_sum(df, ["k"], "t", ["n"], True, cuts),
        "positions": lambda cuts: ordered.positions(df, "t", ["k"], ["n", "id"], cuts=cuts),
        "next": lambda cuts: ordered.next_value(df, ["k"], "t", "next", cuts),
        "fill": lambda cuts: ordered.fill_gaps(once, ["k"], "t", ["n"], True, cuts),
    }
    many = ordered.cut_points(df, "t")
    assert len(many) > 4
    for name, way in ways.items():
        got = rows(way(many))
        assert repr(got) == repr(rows(way([]))) and got, name  # texts, since NaN equals nothing
    # And what one plain window gives.
    df.createOrReplaceTempView("plain")
    falling = spark.sql(
        "SELECT DISTINCT k, t, sum(n) OVER (PARTITION BY k, t) n, sum(n) OVER (PARTITION BY k ORDER BY t DESC) c, "
        "sum(n) OVER (PARTITION BY k) w FROM plain"
    )
    assert repr(rows(ways["falling"](many))) == repr(rows(falling))
    numbers = spark.sql(
        "SELECT k, t, n, id, row_number() OVER (PARTITION BY k ORDER BY t ASC NULLS LAST, n ASC NULLS LAST, id) p FROM plain"
    )
    assert repr(rows(ways["positions"](many))) == repr(rows(numbers))
