import math

import numpy as np
import pytest

from motionframe.llm import whitening as W
from motionframe.llm.queries import queries


def brute(vectors, components=8):
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(v) for v in ((n * x - s) ** 2).sum(axis=1)]
    centred = ((n * x - s) / n).astype(np.float64)
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-9 * max(e[0], 1)).sum()))
    return deviation, centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(df, vectors_by_id):
    """Up to the signs of components."""
    ids = sorted(vectors_by_id)
    deviation, whitened, explained = brute([vectors_by_id[i] for i in ids])
    rows = {(r.vec_id, r.component): r for r in df.collect()}
    k = whitened.shape[1]
    assert set(rows) == {(i, c + 1) for i in ids for c in range(k)}
    got = np.array([[rows[i, c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((got * whitened).sum(axis=0))
    np.testing.assert_allclose(got * signs, whitened, atol=1e-7)
    for a, i in enumerate(ids):
        for c in range(k):
            r = rows[i, c + 1]
            assert (r.n, r.deviation) == (len(ids), deviation[a]) and abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-9


def whole_polynomial(roots):
    out = [1]
    for r in roots:
        out = [(out[k - 1] if k else 0) - r * (out[k] if k < len(out) else 0) for k in range(len(out) + 1)]
    return out


def test_polynomial(spark):
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 7, 12):
        x = rng.integers(-50, 50, (20, d))
        m = [[int(v) for v in row] for row in x.T @ x]
        c = W.polynomial(spark, m)
        assert c[d] == 1 and c[d - 1] == -sum(m[i][i] for i in range(d))
        power, total = np.eye(d, dtype=object), np.zeros((d, d), object)
        for k in range(d + 1):  # a matrix is a root of its own polynomial
            total = total + power * c[k]
            power = power.dot(np.array(m, object))
        assert not total.any()
    zero = [[0] * 4 for _ in range(4)]
    assert W.polynomial(spark, zero) == [0, 0, 0, 0, 1]
    p = W.primes(100)[0]
    permuted = [[0, 0, 0, 9], [0, 4, 0, 0], [0, 0, 4, 0], [9, 0, 0, 0]]  # needs exchanges; roots 9, 4, 4, -9
    assert W.polynomial_modulo(permuted, p) == [v % p for v in whole_polynomial([9, 4, 4, -9])]


@pytest.mark.parametrize("roots", [[5, 5, 5, 2, 0, 7], [1], [3, 3], [10**15, 10**15 - 1, 4, 0, 0], [0, 0], list(range(20))])
def test_roots(roots):
    got = W.largest_roots(whole_polynomial(roots), 8)
    want = sorted((r for r in set(roots) if r), reverse=True)
    assert [(r, m) for r, m in got] == [(r << W.BITS, roots.count(r)) for r in want][: len(got)]
    assert sum(m for _, m in got) >= min(8, sum(r > 0 for r in roots))


def test_irrational_roots_are_close():
    c = [1, -3, 1]  # (3 +- sqrt 5) / 2
    (a, _), (b, _) = W.largest_roots(c, 8)
    assert abs(a / 2**W.BITS - (3 + 5**0.5) / 2) < 1e-15 and abs(b / 2**W.BITS - (3 - 5**0.5) / 2) < 1e-15
    assert W._sign(c, a) >= 0 > W._sign(c, a - 1)


def test_whole_operator(spark):
    """Nulls, NaN, repeated vectors, clashing columns; more dimensions than the rank."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 3)) @ rng.normal(size=(3, 3))
    vectors = {i: [float(np.float32(c)) for c in [*base[i % 100], *base[i % 100][:2], 0.125]] for i in range(120)}
    bad = [(500, None), (501, [None] * 6), (502, [math.nan] * 6), (503, [0.0] * 5 + [-math.inf]), (504, [0.0] * 5)]
    d = spark.createDataFrame([(i, v, 1, 2.0) for i, v in [*vectors.items(), *bad]], "vec_id long, embedding array<float>, n int, whitened double").repartition(3)
    check(W.whitened_rows(d), vectors)


def test_equal_eigenvalues(spark):
    """A cube's corners: one eigenvalue three times; whitened values are orthonormal, whatever basis is taken."""
    corners = [(i, [(i >> k & 1) / 4 for k in range(3)]) for i in range(8)]
    rows = W.whitened_rows(spark.createDataFrame(corners, "vec_id long, embedding array<double>")).collect()
    got = np.zeros((8, 3))
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - 1 / 3) < 1e-12 and r.identity_error < 1e-12
    np.testing.assert_allclose(got.T @ got / 8, np.eye(3), atol=1e-12)
    np.testing.assert_allclose(got @ got.T, [[sum(1 if (i >> k & 1) == (j >> k & 1) else -1 for k in range(3)) for j in range(8)] for i in range(8)], atol=1e-9)


def test_small_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert W.whitened_rows(spark.createDataFrame([], kind)).count() == 0
    assert W.whitened_rows(spark.createDataFrame([(1, [0.1, 0.2])], kind)).count() == 0
    assert W.whitened_rows(spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.1, 0.2])], kind)).count() == 0
    assert W.whitened_rows(spark.createDataFrame([(1, []), (2, [])], kind)).count() == 0
    two = W.whitened_rows(spark.createDataFrame([(1, [0.0, 0.0]), (None, [1.0, 0.0])], kind)).collect()
    assert sorted((r.component, abs(r.whitened), r.explained) for r in two) == [(1, 1.0, 1.0)] * 2


def test_deviation_beyond_64_bits(spark):
    far = spark.createDataFrame([(i, [0.0 if i % 2 else 16384.0]) for i in range(600)], "vec_id long, embedding array<double>")
    n, half = 600, 1 << 24
    want = (n * half // 2) ** 2
    assert {r.deviation for r in W.whitened_rows(far).collect()} == {want if want < 1 << 63 else None}


def test_query(spark):
    d = "/root/testdata/sf0.01"
    check(queries()["op12_exact_whitening"](spark, d), {r.vec_id: r.embedding for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()})
