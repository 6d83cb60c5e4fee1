"""Whitening against numpy's eigenvectors, exact fractions, and what follows from its definition."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayloom.llm import whitening as w
from stayloom.llm.frames import documents


def integer_rows(df):
    out = []
    for r in df.collect():
        v = r["embedding"]
        if v and all(c is not None and math.isfinite(c) for c in v):
            out.append((r["vec_id"], [math.floor(256 * float(c)) for c in v]))
    return out


def check(df, components=4):
    rows = integer_rows(df)
    fit = np.array(sorted({tuple(x) for _, x in rows}))
    n, sums = len(fit), fit.sum(axis=0)
    values, vectors = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    got = w.digest(df).collect()
    assert len(got) == components * len(rows)
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for k in range(components):
        mine = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in got if r["component"] == k + 1)
        theirs = sorted(
            (i, int(((n * np.array(x, object) - sums) ** 2).sum()), float((np.array(x) - sums / n) @ vectors[:, k] / math.sqrt(values[k])))
            for i, x in rows
        )
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        sign = 1 if mine[0][2] * theirs[0][2] > 0 else -1
        assert [m[2] for m in mine] == pytest.approx([sign * t[2] for t in theirs], abs=1e-7)
        assert all(r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9) for r in got if r["component"] == k + 1)


def test_whole_table(spark):
    check(documents(spark, "/root/testdata/sf0.001", "embeddings"))


SCHEMA = "vec_id bigint, embedding array<float>, row string, x int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1) for i, v in rows], SCHEMA).repartition(3)


def test_rows_left_out_and_repeated(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.normal(size=5) * [5, 3, 2, 1.5, 1]]) for i in range(60)]
    rows += [(3, rows[3][1]), (100, rows[4][1])] + [(200 + i, rows[7][1]) for i in range(50)]
    good = vectors(spark, rows)
    check(good)
    bad = [(300, None), (301, []), (302, [1.0, None, 0.0, 0.0, 0.0]), (303, [float("nan")] * 5), (304, [float("-inf")] * 5), (305, [1.0, 2.0])]
    more = sorted(map(tuple, w.digest(vectors(spark, rows + bad)).collect()))
    assert [m[:4] for m in more] == [g[:4] for g in sorted(map(tuple, w.digest(good).collect()))]


def test_rank_and_empty(spark):
    line = [(i, [i * 1.0, i * 2.0, 0.0, 1.0, 0.5]) for i in range(7)]
    got = w.digest(vectors(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)
    assert w.digest(vectors(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).count() == 0
    nothing = w.digest(vectors(spark, []))
    assert nothing.count() == 0 and nothing.columns == w.digest(vectors(spark, line)).columns


def test_null_ids_and_all_columns(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (4, [3.0, -1.0]), (5, [0.0, 9.0])]
    got = w.whitened(vectors(spark, rows))
    assert got.count() == 8 and got.select("row.*").columns == ["vec_id", "embedding", "row", "x"]
    assert got.where("row.vec_id IS NULL").count() == 4


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([[1e15, 0.0], [-1e15, 1.0], [3e14, 2.0], [7.0, 5e14]])]
    got = w.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    for r in got.select("row.vec_id", "deviation", "identity_error").collect():
        assert r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 2**63 else None) and r["identity_error"] < 1e-9


def determinant_polynomial(m):
    """Faddeev-LeVerrier in fractions: coefficients of det(x I - m) from x^0."""
    d = len(m)
    a = [[Fraction(v) for v in row] for row in m]
    b, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        for i in range(d):
            b[i][i] += out[-1]
        b = [[sum(a[i][l] * b[l][j] for l in range(d)) for j in range(d)] for i in range(d)]
        out.append(-sum(b[i][i] for i in range(d)) / k)
    return [int(c) for c in reversed(out)]


@pytest.mark.parametrize("seed", range(3))
def test_polynomial_is_exact(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-400, 400, (9 + seed, 6 + seed))
    x[:, 1] = x[:, 0] if seed == 1 else x[:, 1]
    m = [[int(v) for v in row] for row in x.T @ x]
    assert w.polynomial(spark, m) == determinant_polynomial(m)


def test_zero_columns_below_the_diagonal(spark):
    m = [[4, 0, 0, 1], [0, 4, 0, 0], [0, 0, 9, 0], [1, 0, 0, 2]]
    assert w.polynomial(spark, m) == determinant_polynomial(m)


def test_roots_and_repeated_ones():
    # (x - 7)^2 (x - 3) x and a pair of roots 10^-9 apart
    coefficients = determinant_polynomial([[7, 0, 0, 0], [0, 7, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0]])
    assert [w.roots_above(coefficients, a, 0) for a in (0, 2, 3, 6, 7)] == [3, 3, 2, 2, 0]
    for k, value, ends in ((1, 7, (1, 2)), (2, 7, (1, 2)), (3, 3, (3, 3))):
        root = w.kth_root(coefficients, k)
        assert root.number < value * 2**root.shift <= root.number + 1 and (root.first, root.last) == ends
    assert w.kth_root(coefficients, 4) is None
    near = [10**18, 10**18 + 1]
    first, second = (w.kth_root([near[0] * near[1], -sum(near), 1], k) for k in (1, 2))
    assert (first.first, first.last, second.first, second.last) == (1, 1, 2, 2)


def test_components_of_near_and_equal_eigenvalues():
    # Eigenvalues 10^18 + 2 and 10^18: beyond doubles.
    m = [[10**18 + 1, 1], [1, 10**18 + 1]]
    coefficients = determinant_polynomial(m)
    for k, sign in ((1, 1), (2, -1)):
        v = w.null_space(m, w.kth_root(coefficients, k))[0]
        assert v[0] * v[1] * sign == pytest.approx(0.5)
    equal = [[5, 0, 0], [0, 5, 0], [0, 0, 1]]
    block = w.null_space(equal, w.kth_root(determinant_polynomial(equal), 1))
    assert block @ block.T == pytest.approx(np.eye(2)) and np.abs(block[:, 2]).max() < 1e-30


def test_primes():
    found = w.primes(2**100)
    assert found[0] == 2**31 - 1 and math.prod(found) > 2**100 and all(pow(3, p - 1, p) == 1 for p in found)
    assert [n for n in range(2, 40) if w._is_prime(n)] == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37]


def test_equal_eigenvalues_give_one_basis(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, -1.0, 0.0]), (4, [0.0, 0.0, 0.25]), (5, [0.0, 0.0, -0.25])]
    df = vectors(spark, rows)
    first, again = (sorted(map(tuple, w.digest(df).collect())) for _ in range(2))
    assert first == again and {r["component"] for r in w.digest(df).collect()} == {1, 2, 3}
    assert first[0][-1] < 1e-9 and w.digest(df).where(F.isnan("whitened")).count() == 0
