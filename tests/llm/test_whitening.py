"""Whitening against exact rational arithmetic."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from quire.llm.polar_whitening import fits, polarised, whiten, whole_entries

SCHEMA = "vec_id long, embedding array<float>, label int, x string, dims int, n long"


def rows_of(n=300, dims=11, seed=1, spread=0.3):
    rng = np.random.default_rng(seed)
    mix = rng.normal(0, spread, (dims, dims))
    return [(i, [float(np.float32(v)) for v in rng.normal(0, 1, dims) @ mix + 5], 0, "x", 1, 2) for i in range(n)]


def exact(vectors, scale=1024, offset=100_000):
    x = [[math.floor(scale * v) + offset for v in row] for row in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(dims)]
    y = [[n * r[k] - s[k] for k in range(dims)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(dims)] for i in range(dims)])
    return x, s, y, cov


def check(out, ids, vectors, components=8):
    x, s, y, cov = exact(vectors)
    n, dims = len(x), len(x[0])
    e = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(components, dims)
    assert len(out) == n * k
    by = [sorted((r for r in out if r.component == c + 1), key=lambda r: (r.vec_id is None, r.vec_id, r.deviation)) for c in range(k)]
    assert {r.n for r in out} == {n} and len({r.identity_error for r in out}) == 1
    assert max(r.identity_error for r in out) < 1e-9
    for c in range(k):
        assert all(math.isclose(r.explained, e[c] / np.trace(cov), rel_tol=1e-9) for r in by[c])
    deviations = sorted(sum(v * v for v in row) for row in y)
    assert sorted(r.deviation for r in by[0]) == deviations
    w = np.array([[r.whitened for r in rows] for rows in by]).T
    order = sorted(range(n), key=lambda i: (ids[i] is None, ids[i], sum(v * v for v in y[i])))
    centred = np.array([[float(Fraction(v, n)) for v in y[i]] for i in order])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9
    # Each whitened column is the projection on a unit eigenvector, over sqrt(e).
    v, *_ = np.linalg.lstsq(centred, w * np.sqrt(e[:k]), rcond=None)
    assert np.abs(cov @ v - v * e[:k]).max() < 1e-6 * e[0] and np.allclose((v * v).sum(axis=0), 1)


def test_whitening_is_exact(spark):
    rows = rows_of()
    rows += [(7, rows[3][1], 0, "x", 1, 2), rows[5], (None, rows[9][1], None, None, None, None)]
    bad = [(900, None, 0, "", 0, 0), (901, [1.0, None] + [0.0] * 9, 0, "", 0, 0), (902, [math.nan] * 11, 0, "", 0, 0), (903, [math.inf] + [0.0] * 10, 0, "", 0, 0), (904, [], 0, "", 0, 0)]
    out = whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(7)).collect()
    check(out, [r[0] for r in rows], [r[1] for r in rows])


def test_lengths_are_lists_of_their_own(spark):
    a, b = rows_of(60, 4, 2), [(1000 + r[0], *r[1:]) for r in rows_of(50, 9, 3)]
    out = whiten(spark.createDataFrame(a + b, SCHEMA)).collect()
    check([r for r in out if r.vec_id < 1000], [r[0] for r in a], [r[1] for r in a])
    check([r for r in out if r.vec_id >= 1000], [r[0] for r in b], [r[1] for r in b])


def test_no_variance_no_component_and_nothing(spark):
    same = [(i, [0.5, -2.0], 0, "", 0, 0) for i in range(9)]
    assert whiten(spark.createDataFrame(same, SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    line = [(i, [0.5 * i, 7.0, 1.0 * i], 0, "", 0, 0) for i in range(9)]
    out = whiten(spark.createDataFrame(line, SCHEMA)).collect()
    assert {r.component for r in out} == {1} and math.isclose(out[0].explained, 1.0) and len(out) == 9


def test_a_large_mean_costs_no_precision(spark):
    rng = random.Random(3)
    rows = [(i, [1e6 + rng.choice([0, 1, 2]) / 16, -3e5 + rng.choice([0, 1]) / 16, rng.gauss(0, 1)], 0, "", 0, 0) for i in range(500)]
    found = fits(whole_entries(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, x string, dims int, n long"), "vec_id", "embedding", 1024.0, 100_000), 8)[3]
    cov = exact([r[1] for r in rows])[3]
    assert (found.covariance == cov).all()


def test_sums_have_no_rounding():
    rng = np.random.default_rng(5)
    for bits in (20, 40, 61):
        y = rng.integers(-(2 ** (bits - 2)), 2 ** (bits - 2), (2048, 5))
        got = [0] * 15
        for power, sums in polarised(y, bits):
            got = [g + (int(s) << 25 * power) for g, s in zip(got, sums)]
        rows = [[int(v) for v in r] for r in y]
        want = [sum(r[i] ** 2 for r in rows) for i in range(5)]
        want += [sum((r[i] + r[j]) ** 2 for r in rows) for i in range(5) for j in range(i + 1, 5)]
        assert got == want


def test_limits_are_stated(spark):
    far = spark.createDataFrame([(1, [1e30, 1.0], 0, "", 0, 0), (2, [1.0, 1.0], 0, "", 0, 0)], SCHEMA)
    with pytest.raises(Exception, match="after scaling"):
        whiten(far).count()
