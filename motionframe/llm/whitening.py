"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

With x the integer vectors, n their number and S their sums, the scatter M = n * sum(x xT) - S ST is an integer matrix, and
the covariance is M / n^2. Sums are exact: 64-bit within a batch, Python integers within a task, decimals across tasks.

- Polynomial: det(t I - M) modulo primes under 2^31, by reduction to Hessenberg form and the recurrence of its leading minors;
  as many primes as the coefficients' bound needs (eigenvalues are not negative, so with T the trace the k-th is at most
  C(d, k) (T/d)^k). Primes are dealt to tasks; Chinese remaindering gives the integer coefficients.
- Roots: all are real, so the roots above a are as many as the sign changes of the polynomial shifted by a (Descartes' rule is
  exact then). Halving intervals by that count isolates the largest roots; a root alone in its interval is halved on by the
  polynomial's sign. All in integers at 2^-BITS of a unit. Roots nearer to each other than that count as one multiple root.
- Components: inverse iteration on M - t I with `PRECISION` decimal digits; a multiple root's vectors are made orthogonal.
  Of both signs the one is taken whose largest component (the first of equal ones) is positive.

Components of eigenvalue 0 do not exist: there are as many as the rank, and `COMPONENTS` at most. One vector, or equal ones
only, give no rows, as does an empty table. Rows: see `vectors` for those that are dropped; ids may be null or repeated, each
row counts. Extra columns are not read. `deviation` is null where it exceeds 64 bits (from millions of rows on).

The driver holds the d x d scatter and polynomials, whatever the number of rows; d is meant to be some hundreds at most.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.llm.vectors import dimension, matrices
from motionframe.session import written

COMPONENTS = 8
OFFSET = 100_000
#: Binary places of roots, and decimal digits of components.
BITS, PRECISION = 192, 120
#: Primes that a task takes.
PRIMES_A_TASK = 16


@dataclass
class Whitening:
    """sums: of the integer vectors, with their offset. components: one a row. values: eigenvalues of the covariance."""

    dim: int
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray


# The scatter


def moments(rows: DataFrame, vector_col: str, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of the kept vectors, exact, without the offset."""
    upper = np.triu_indices(dim)
    made = pa.schema([("at", pa.int32()), ("total", pa.decimal128(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(dim, object), np.zeros((dim, dim), object)
        for _, x in matrices(batches, dim):
            n += len(x)
            sums += x.sum(axis=0).astype(object)
            most = int(np.abs(x).max(initial=0))
            if len(x) * most * most < 1 << 53:
                f = x.astype(np.float64)
                products += (f.T @ f).astype(np.int64).astype(object)
            else:
                few = max(1, (1 << 62) // max(1, most * most))  # rows whose products 64 bits hold
                for i in range(0, len(x), few):
                    products += (x[i : i + few].T @ x[i : i + few]).astype(object)
        if n:
            values = [n, *sums.tolist(), *products[upper].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(map(Decimal, values), pa.decimal128(38, 0))], schema=made)

    each = rows.select(vector_col).mapInArrow(run, "at int, total decimal(38,0)")
    found = {r["at"]: int(r["total"]) for r in each.groupBy("at").agg(F.sum("total").alias("total")).collect()}  # of the size of the scatter
    values = [found[i] for i in range(1 + dim + len(upper[0]))] if found else [0] * (1 + dim + len(upper[0]))
    products = [[0] * dim for _ in range(dim)]
    for i, j, v in zip(*map(np.ndarray.tolist, upper), values[1 + dim :]):
        products[i][j] = products[j][i] = v
    return values[0], values[1 : 1 + dim], products


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    return [[n * products[i][j] - sums[i] * sums[j] for j in range(len(sums))] for i in range(len(sums))]


# The characteristic polynomial


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(t I - matrix) modulo the prime p < 2^31, the constant first."""
    d = len(matrix)
    h = np.array([[v % p for v in row] for row in matrix], np.int64).reshape(d, d)
    for k in range(1, d - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        at = k + int(below[0])
        if at != k:
            h[[k, at]] = h[[at, k]]
            h[:, [k, at]] = h[:, [at, k]]
        u = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - u[:, None] * h[k][None] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * u % p).sum(axis=1)) % p
    minors = np.zeros((d + 1, d + 1), np.int64)  # of the leading k rows
    minors[0, 0] = 1
    for k in range(1, d + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        step, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * step % p
            step = step * int(h[i, i - 1]) % p if i else 0
        minors[k] = (minors[k] - (weights[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[d].tolist()


def primes(bits: int) -> list[int]:
    """The largest primes under 2^31 whose product has more than so many bits."""
    small = [p for p in range(2, 46341) if all(p % q for q in range(2, math.isqrt(p) + 1))]
    out, left, at = [], bits, (1 << 31) - 1
    while left >= 0:
        if all(at % q for q in small):
            out.append(at)
            left -= 30  # each is over 2^30
        at -= 2
    return out


def polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(t I - matrix), the constant first; the matrix has no negative eigenvalue."""
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    most = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    ps = primes(most.bit_length() + 1)
    made = pa.schema([("p", pa.int64()), ("coefficients", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([polynomial_modulo(matrix, p) for p in some], pa.list_(pa.int64()))], schema=made)

    dealt = spark.createDataFrame([(p,) for p in ps], "p long").repartition(-(-len(ps) // PRIMES_A_TASK))
    found = {r["p"]: r["coefficients"] for r in dealt.mapInArrow(run, "p bigint, coefficients array<bigint>").collect()}  # d + 1 numbers a prime
    whole = math.prod(ps)
    out = [0] * (d + 1)
    for p in ps:
        rest = whole // p
        one = rest * pow(rest, -1, p)
        for k, c in enumerate(found[p]):
            out[k] += c * one
    return [v - whole if 2 * (v := c % whole) > whole else v for c in out]


# Its roots


def _scaled(coefficients: list[int], at: int) -> tuple[list[int], int]:
    """The polynomial in units of 2^-s, and at, given in 2^-BITS, in these units, for the least s."""
    s = BITS - min(BITS, (at & -at).bit_length() - 1) if at else 0
    d = len(coefficients) - 1
    return [c << s * (d - k) for k, c in enumerate(coefficients)], at >> BITS - s


def roots_above(coefficients: list[int], at: int) -> int:
    """Roots over at, with multiplicity; at in 2^-BITS. All roots are real."""
    c, a = _scaled(coefficients, at)
    d = len(c) - 1
    for i in range(d):  # shift by a
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(coefficients: list[int], at: int) -> int:
    c, a = _scaled(coefficients, at)
    value = 0
    for v in reversed(c):
        value = value * a + v
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], most: int) -> list[tuple[int, int]]:
    """(root in 2^-BITS, multiplicity), falling, until `most` positive roots are there; the last may bring more."""
    top = (-coefficients[-2] + 1) << BITS  # over the trace
    out: list[tuple[int, int]] = []
    todo = [(0, top, roots_above(coefficients, 0), 0)]
    while todo and sum(m for _, m in out) < most:
        low, high, over_low, over_high = todo.pop()  # intervals (low, high], the highest last
        m = over_low - over_high
        if not m:
            continue
        if high - low <= 1:
            out.append((high, m))
        elif m == 1:
            out.append((_alone(coefficients, low, high), 1))
        else:
            mid = _between(low, high)
            over = roots_above(coefficients, mid)
            todo += [(low, mid, over_low, over), (mid, high, over, over_high)]
    return out


def _between(low: int, high: int) -> int:
    """A number between them, near the middle, that has few binary places."""
    s = max(0, (high - low).bit_length() - 3)
    return (low + high) // 2 >> s << s if s and low < (low + high) // 2 >> s << s < high else (low + high) // 2


def _alone(coefficients: list[int], low: int, high: int) -> int:
    """The root in (low, high], the only one there."""
    above = _sign(coefficients, high)
    if not above:
        return high
    while high - low > 1:
        mid = _between(low, high)
        if (sign := _sign(coefficients, mid)) == 0:
            return mid
        low, high = (low, mid) if sign == above else (mid, high)
    return high


# Components


def _solved(lu: np.ndarray, order: list[int], b: list[Decimal]) -> np.ndarray:
    x = np.array([b[i] for i in order], object)
    for i in range(1, len(x)):
        x[i] -= (lu[i, :i] * x[:i]).sum()
    for i in range(len(x) - 1, -1, -1):
        x[i] = (x[i] - (lu[i, i + 1 :] * x[i + 1 :]).sum()) / lu[i, i]
    return x


def null_space(matrix: list[list[int]], root: Decimal, multiplicity: int) -> list[np.ndarray]:
    """So many orthonormal vectors v with matrix v = root v, as decimals."""
    d = len(matrix)
    a = np.array([[Decimal(v) for v in row] for row in matrix], object).reshape(d, d)
    tiny = (abs(root) + 1).scaleb(-PRECISION)
    for i in range(d):
        a[i, i] -= root
    order = list(range(d))
    for k in range(d):
        at = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        if at != k:
            a[[k, at]] = a[[at, k]]
            order[k], order[at] = order[at], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1 :, k] /= a[k, k]
            a[k + 1 :, k + 1 :] -= np.outer(a[k + 1 :, k], a[k, k + 1 :])
    rng, out = random.Random(d), []
    for _ in range(multiplicity):
        x = np.array([Decimal(rng.randint(1, 1 << 30)) for _ in range(d)], object)
        for _ in range(3):
            x = _solved(a, order, list(x))
            for v in out:
                x = x - v * (v * x).sum()
            x = x / (x * x).sum().sqrt()
        out.append(x)
    return out


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """None if there are no vectors or all are equal."""
    dim = dimension(rows, vector_col)
    if not dim:
        return None
    n, sums, products = moments(rows, vector_col, dim)
    m = scatter(n, sums, products)
    trace = sum(m[i][i] for i in range(dim))
    if not trace:
        return None
    vectors, values = [], []
    with localcontext() as digits:
        digits.prec = PRECISION + 2 * len(str(trace))
        for root, multiplicity in largest_roots(polynomial(rows.sparkSession, m), components):
            t = Decimal(root) / (1 << BITS)
            vectors += null_space(m, t, multiplicity)
            values += [t] * multiplicity
        made = np.array([[float(v) for v in x] for x in vectors[:components]])
        e = np.array([float(t / (n * n)) for t in values[:components]])
        explained = np.array([float(t / trace) for t in values[:components]])
    made *= np.sign(made[np.arange(len(made)), np.abs(made).argmax(axis=1)])[:, None]
    return Whitening(dim, n, [s + n * OFFSET for s in sums], made, e, explained)


def apply(rows: DataFrame, model: Whitening, keep: list[str], vector_col: str = "embedding") -> DataFrame:
    """The columns `keep`, deviation and whitened, an array with one number a component."""
    sums = np.array([s - model.n * OFFSET for s in model.sums], object)
    mean = np.array([float(Decimal(int(s)) / model.n) for s in sums])
    project = (model.components / np.sqrt(model.values)[:, None]).T
    exact = model.n < 1 << 38 and all(abs(s) < 1 << 62 for s in sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in matrices(batches, model.dim):
            apart = x * model.n - sums.astype(np.int64) if exact else x.astype(object) * model.n - sums
            if model.dim * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 63:
                deviation = (apart * apart).sum(axis=1).tolist()
            else:
                deviation = [v if v < 1 << 63 else None for v in (apart.astype(object) ** 2).sum(axis=1)]
            whitened = (x - mean) @ project
            ends = pa.array(np.arange(len(x) + 1) * project.shape[1], pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(whitened.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(deviation, pa.int64()), lists], names=[*batch.schema.names[1:], "deviation", "whitened"])

    source = rows.select(F.col(vector_col).alias("__vector"), *(F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)))
    kinds = [f"{c} {t}" for c, t in source.dtypes[1:]]
    out = source.mapInArrow(run, ", ".join([*kinds, "deviation bigint", "whitened array<double>"]))
    return out.select(*(F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)), "deviation", "whitened")


def identity_error(whitened: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of `whitened` (arrays of k numbers) less the identity; two passes."""
    w = lambda i: F.col("whitened")[i]
    mean = whitened.agg(*(F.avg(w(i)).alias(f"m{i}") for i in range(k))).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = whitened.agg(*(F.avg((w(i) - mean[i]) * (w(j) - mean[j])).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_rows(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id_col, component, n, deviation, whitened, explained and identity_error, one row a vector and component."""
    spark = rows.sparkSession
    rows = rows.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__vector_in"))
    model = fit(rows, "__vector_in", components)
    kinds = f"`{id_col}` {rows.dtypes[0][1]}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], kinds)
    k = len(model.values)
    wide = written(apply(rows, model, ["__id"], "__vector_in"), "whitened")
    error = identity_error(wide, k)
    each = wide.select("__id", "deviation", F.posexplode("whitened").alias("at", "w"))
    return each.select(
        F.col("__id").alias(id_col),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.array(*map(F.lit, model.explained.tolist()))[F.col("at")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
