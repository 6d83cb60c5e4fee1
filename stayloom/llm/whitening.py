"""Whitening of embeddings along principal components taken from the exact characteristic polynomial.

* Entries become integers, x = floor(256 * c).  The fit list is each distinct x vector once.
* Scatter: every task adds up its vectors' products as exact integers; the sums of the tasks are added
  by Spark, limb by limb.  With n vectors, sums S and products P the scatter is M = n * P - S * S', an
  integer matrix; the covariance is V = M / n^2, centred without rounding.
* Characteristic polynomial: one row a prime is dealt out; its task brings M modulo the prime into
  Hessenberg form and reads the polynomial off.  The residues of each coefficient meet by coefficient and
  are joined by Chinese remaindering.  M is positive semidefinite, so its k-th elementary symmetric
  function lies between 0 and C(d, k) * (trace / d)^k (Maclaurin); the primes' product exceeds that.
* Roots: all are real, so Descartes' rule is exact: the sign changes of p(x + a) are the roots above a.
  One task a component halves an interval with exact integers until the k-th root is known to a
  relative 2^-DIGITS, whatever its distance to the next root.
* Components: inverse iteration with the integer matrix less the root, in decimal arithmetic of PRECISION
  digits.  Roots that agree as far as known are one eigenvalue: the block of its null space is iterated
  and made orthogonal, and any orthonormal basis of it will do; the one taken depends on M alone.

What a component's task holds are d x d numbers and d + 1 coefficients, d being the length of a vector,
whatever the number of rows.  The driver holds n, S, M and four components.

Rows whose vector is null or empty or has a null or non-finite entry are left out.  Vectors of another
length than most (of two lengths in as many rows, the greater counts) cannot be compared and are left
out as well.  Entries beyond a long are cut to its ends.  Components of eigenvalue 0 cannot be scaled to
one; they are no components, so that a single vector, or equal ones, give no row.  Null and repeated ids
are kept as they are, and an empty table gives an empty one.  `deviation` is null where it exceeds a long.
The columns of the input are all kept by `whitened`, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayloom.llm.frames import ready, settle

SCALE = 256
COMPONENTS = 4
DIGITS = 160  # bits to which a root is known, relative to itself
PRECISION = 110  # decimal digits of the inverse iteration
WORK = 10**7  # cells to eliminate in a task, about a second
_LIMB, _LIMBS = 30, 6


def integers(vector: Column) -> Column:
    """floor(256 * c) of each entry as long; null for a vector that is not to be used."""
    numbers = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(numbers, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = F.transform(numbers, lambda c: F.floor(c * F.lit(float(SCALE))))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, whole)


# --- the scatter ------------------------------------------------------------------------------


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), length)


def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products of the rows, exact: in doubles as long as they are whole numbers there."""
    largest = int(np.abs(x.astype(object)).max(initial=0)) if x.size else 0
    if largest * largest * max(1, len(x)) < 2**53:
        whole = x.astype(np.float64)
        return whole.sum(axis=0).astype(np.int64).astype(object), (whole.T @ whole).astype(np.int64).astype(object)
    x = x.astype(object)
    return x.sum(axis=0), x.T @ x


def scatter(fit: DataFrame, length: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, M) of the distinct vectors in column x, all exact."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums, products = 0, np.zeros(length, object), np.zeros((length, length), object)
        for batch in batches:
            s, p = _sums(_matrix(batch.column(0), length))
            rows, sums, products = rows + batch.num_rows, sums + s, products + p
        if not rows:
            return
        above = np.triu_indices(length)
        values = [rows, *sums, *products[above]]
        place = np.arange(len(values), dtype=np.int32)
        # All limbs but the last are below 2^30, so that their sums over 2^33 tasks fit a long.
        limbs = [[(v >> (_LIMB * k)) & ((1 << _LIMB) - 1) for v in map(int, values)] for k in range(_LIMBS - 1)]
        limbs.append([int(v) >> (_LIMB * (_LIMBS - 1)) for v in values])
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), *[pa.array(l, pa.int64()) for l in limbs]], ["place", *[f"limb_{k}" for k in range(_LIMBS)]]
        )

    schema = "place int, " + ", ".join(f"limb_{k} long" for k in range(_LIMBS))
    added = fit.select("x").mapInArrow(partial, schema).groupBy("place").agg(
        *[F.sum(f"limb_{k}").alias(f"limb_{k}") for k in range(_LIMBS)]
    )
    # One row for n, each dimension and each pair of dimensions.
    found = {r["place"]: sum(r[f"limb_{k}"] << (_LIMB * k) for k in range(_LIMBS)) for r in added.collect()}
    if not found:
        return 0, [0] * length, [[0] * length for _ in range(length)]
    n, sums = found[0], [found[1 + i] for i in range(length)]
    matrix, at = [[0] * length for _ in range(length)], 1 + length
    for i in range(length):
        for j in range(i, length):
            matrix[i][j] = matrix[j][i] = n * found[at] - sums[i] * sums[j]
            at += 1
    return n, sums, matrix


# --- the characteristic polynomial ------------------------------------------------------------


def hessenberg_polynomial(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients modulo the prime p of det(x * I - matrix), from x^0 to x^d; p is below 2^31."""
    h, d = matrix % p, len(matrix)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        if below[0]:
            i = k + int(below[0])
            h[[k, i]] = h[[i, k]]
            h[:, [k, i]] = h[:, [i, k]]
        factors = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factors[:, None] * h[k] % p) % p
        # Adding the columns times their factors to column k makes it a similarity.
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factors % p).sum(axis=1)) % p
    polynomials = np.zeros((d + 1, d + 1), np.int64)
    polynomials[0, 0] = 1
    for k in range(d):
        new = np.zeros(d + 1, np.int64)
        new[1:] = polynomials[k, :-1]
        weights, chain = np.zeros(k + 1, np.int64), 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * chain % p
            if i:
                chain = chain * int(h[i, i - 1]) % p
        new = (new - (polynomials[: k + 1] * weights[:, None] % p).sum(axis=0)) % p
        polynomials[k + 1] = new
    return [int(c) for c in polynomials[d]]


def _is_prime(n: int) -> bool:
    """Exact below 3,215,031,751, which four Miller-Rabin bases decide."""
    if n < 11 or n % 2 == 0:
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes(above: int) -> list[int]:
    """The largest primes below 2^31 whose product exceeds a bound."""
    out, product, n = [], 1, 2**31 - 1
    while product <= above:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial(spark: SparkSession, matrix: Sequence[Sequence[int]]) -> list[int]:
    """det(x * I - M) of a positive semidefinite integer matrix, coefficients from x^0 to x^d."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    bound = max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1))
    moduli = primes(bound)
    each = max(1, WORK // d**3)
    rows = spark.createDataFrame([(m,) for m in moduli], "prime long").repartition(-(-len(moduli) // each))

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame["prime"]:
                reduced = np.array([[v % p for v in row] for row in matrix], np.int64)
                found = hessenberg_polynomial(reduced, int(p))
                # The k-th elementary symmetric function is the coefficient of x^(d - k) without its sign.
                yield pd.DataFrame({"k": range(d + 1), "prime": p, "residue": [(-1) ** k * found[d - k] % p for k in range(d + 1)]})

    def joined(frame: pd.DataFrame) -> pd.DataFrame:
        value, modulus = 0, 1
        for p, r in sorted(zip(frame["prime"], frame["residue"], strict=True)):
            value += modulus * ((int(r) - value) * pow(modulus, -1, int(p)) % int(p))
            modulus *= int(p)
        return pd.DataFrame({"k": [int(frame["k"].iloc[0])], "value": [str(value)]})

    found = (
        rows.mapInPandas(residues, "k int, prime long, residue long")
        .groupBy("k")
        .applyInPandas(joined, "k int, value string")
        .collect()
    )
    symmetric = {r["k"]: int(r["value"]) for r in found}
    return [(-1) ** (d - i) * symmetric[d - i] for i in range(d + 1)]


# --- roots ------------------------------------------------------------------------------------


def roots_above(coefficients: Sequence[int], number: int, shift: int) -> int:
    """How many roots, with multiplicity, exceed number / 2^shift; all roots are real."""
    d = len(coefficients) - 1
    # q(y) = 2^(shift * d) * p(y / 2^shift) has whole coefficients; then y is moved by `number`.
    q = [c << (shift * (d - i)) for i, c in enumerate(coefficients)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            q[j] += number * q[j + 1]
    signs = [c > 0 for c in q if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


@dataclass
class Root:
    """The k-th greatest root lies in (number, number + 1] / 2^shift, together with roots first..last."""

    number: int
    shift: int
    first: int
    last: int


def kth_root(coefficients: Sequence[int], k: int, bits: int = DIGITS) -> Root | None:
    """The k-th greatest root (from 1), or None if it is not positive."""
    if roots_above(coefficients, 0, 0) < k:
        return None
    d = len(coefficients) - 1
    high = 1
    while roots_above(coefficients, high, 0) >= k:
        high *= 2
    low, shift = 0, 0
    # low < root <= high, in units of 2^-shift, until high - low is 1 and low has `bits` bits.
    above_low, above_high = roots_above(coefficients, low, 0), roots_above(coefficients, high, 0)
    while high - low > 1 or low.bit_length() < bits:
        if high - low == 1:
            low, high, shift = 2 * low, 2 * high, shift + 1
        middle = (low + high) // 2
        if above_low - above_high == 1:
            # The only root in the interval: p has the sign (-1)^(roots above) at the middle.
            value, power = 0, 1
            for i in range(d, -1, -1):
                value = value * middle + coefficients[i] * power
                power <<= shift
            count = above_high if value == 0 or (value > 0) == (above_high % 2 == 0) else above_low
        else:
            count = roots_above(coefficients, middle, shift)
        if count >= k:
            low, above_low = middle, count
        else:
            high, above_high = middle, count
    return Root(low, shift, above_high + 1, above_low)


# --- components -------------------------------------------------------------------------------


def null_space(matrix: Sequence[Sequence[int]], root: Root, precision: int = PRECISION) -> np.ndarray:
    """Orthonormal vectors, as rows, of the eigenvalues that `root` stands for.

    Block inverse iteration with M - root * I, whose pivots that vanish are replaced by the least number
    that counts: the block then falls into the null space in a step, the second one cleans it.
    """
    d, wanted = len(matrix), root.last - root.first + 1
    with localcontext() as context:
        context.prec = precision
        context.Emax, context.Emin = 999_999, -999_999
        value = (Decimal(2 * root.number + 1)) / (Decimal(2) ** (root.shift + 1))
        size = max(Decimal(abs(v)) for row in matrix for v in row)
        tiny = size * Decimal(10) ** -(precision - 5)
        a = np.array([[Decimal(v) for v in row] for row in matrix], object)
        for i in range(d):
            a[i, i] -= value
        order = list(range(d))
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= a[k + 1 :, k : k + 1] * a[k : k + 1, k + 1 :]
        # Fixed starting vectors without pattern: the fractional parts of multiples of the golden ratio.
        golden = (Decimal(5).sqrt() - 1) / 2
        block = np.array([[((i + 1) * (j + 1) ** 2 * golden) % 1 - Decimal("0.5") for i in range(d)] for j in range(wanted)], object)
        for _ in range(3):
            solved = []
            for vector in block:
                y = vector[order]
                for k in range(1, d):
                    y[k] -= (a[k, :k] * y[:k]).sum()
                for k in range(d - 1, -1, -1):
                    rest = (a[k, k + 1 :] * y[k + 1 :]).sum() if k + 1 < d else 0
                    y[k] = (y[k] - rest) / a[k, k]
                for earlier in [*solved, *solved]:
                    y = y - earlier * (earlier * y).sum()
                solved.append(y / (y * y).sum().sqrt())
            block = np.array(solved, object)
        return block.astype(np.float64)


@dataclass
class Model:
    """n vectors with sums S; components as rows with the eigenvalues of V and their share of its trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: list[float]
    explained: list[float]


def fit_model(fit: DataFrame, length: int, components: int = COMPONENTS) -> Model:
    """The greatest `components` components of the distinct vectors in column x, of positive eigenvalue."""
    spark = fit.sparkSession
    n, sums, matrix = scatter(fit, length)
    trace = sum(matrix[i][i] for i in range(length))
    if trace == 0:
        return Model(n, sums, np.zeros((0, length)), [], [])
    coefficients = polynomial(spark, matrix)
    wanted = min(components, length)

    def solved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in map(int, frame["k"]):
                root = kth_root(coefficients, k)
                if root:
                    vector = null_space(matrix, root)[k - root.first]
                    vector = vector * (1.0 if vector[np.argmax(np.abs(vector))] > 0 else -1.0)
                    yield pd.DataFrame({"k": [k], "number": [str(root.number)], "shift": [root.shift], "vector": [vector.tolist()]})

    ks = spark.createDataFrame([(k,) for k in range(1, wanted + 1)], "k int").repartition(wanted, "k")
    rows = sorted(ks.mapInPandas(solved, "k int, number string, shift int, vector array<double>").collect(), key=lambda r: r["k"])
    values = [(2 * int(r["number"]) + 1, 2 ** (r["shift"] + 1)) for r in rows]  # eigenvalues of M as fractions
    return Model(
        n, sums,
        np.array([r["vector"] for r in rows]).reshape(len(rows), length),
        [a / (b * n * n) for a, b in values],
        [a / (b * trace) for a, b in values],
    )


# --- whitening --------------------------------------------------------------------------------


def _scored(df: DataFrame, model: Model) -> DataFrame:
    """The rows of `df`, which has vectors x, with `deviation` as a long and `whitened` as an array."""
    n, length, k = model.n, len(model.sums), len(model.values)
    sums = np.array(model.sums, object)
    scale = np.array([1 / (n * math.sqrt(e)) for e in model.values])
    vectors = model.vectors.T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), length)
            largest = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1)
            furthest = n * largest + max(map(abs, model.sums), default=0)
            if furthest * furthest * length < 2**63:
                centred = x * n - sums.astype(np.int64)
                deviation = (centred * centred).sum(axis=1).tolist()
            else:
                centred = x.astype(object) * n - sums
                deviation = [v if v < 2**63 else None for v in map(int, (centred * centred).sum(axis=1))] if len(x) else []
            white = centred.astype(np.float64) @ vectors * scale
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * k, pa.array(white.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in batch.schema.names if c != "x"], pa.array(deviation, pa.int64()), lists],
                [*[c for c in batch.schema.names if c != "x"], "deviation", "whitened"],
            )

    kept = [f for f in df.schema.fields if f.name != "x"]
    schema = T.StructType([*kept, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return df.mapInArrow(run, schema)


def identity_error(fit: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened fit list's covariance, less the identity."""
    k = len(model.values)
    white = _scored(fit.select("x"), model).select(*[F.col("whitened")[i].alias(f"w_{i}") for i in range(k)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.covar_pop(f"w_{i}", f"w_{j}").alias(f"c_{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c_{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The usable rows of `df` as a struct `row`, one for each component, with component, n, deviation,
    whitened, explained and identity_error."""
    spark = ready(df.sparkSession)
    schema = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    usable = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), integers(F.col(f"`{vector}`")).alias("x"))
    usable = usable.where("x IS NOT NULL")
    lengths = usable.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    model = None
    if lengths:
        usable = usable.where(F.size("x") == lengths["length"])
        fit = settle(usable.select("x").distinct())
        model = fit_model(fit, lengths["length"], components)
    if model is None or not model.values:
        row = usable.select("row").schema["row"].dataType.simpleString()
        return spark.createDataFrame([], f"row {row}, {schema}")
    error = identity_error(fit, model)
    shares = F.array(*[F.lit(e) for e in model.explained])
    each = _scored(usable, model).select("row", "deviation", F.posexplode("whitened").alias("at", "white"))
    return each.select(
        "row",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("white").alias("whitened"),
        shares[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def digest(embeddings: DataFrame) -> DataFrame:
    found = whitened(embeddings.select("vec_id", "embedding"))
    return found.select("row.vec_id", *[c for c in found.columns if c != "row"])
