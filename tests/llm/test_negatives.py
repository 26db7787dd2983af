"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest

from quire.llm.l2_negatives import FAR, BlockIndex, mine_negatives, remaining_norms

SCHEMA = "vec_id long, embedding array<float>, label int, row long, k int, high long, q string"


def brute(rows, every=10, keep=5):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    use = [(r[0], r[2], [math.floor(256 * float(np.float32(x))) for x in r[1]], i) for i, r in enumerate(rows) if r[0] is not None and r[2] is not None and ok(r[1])]
    out = []
    for a, la, q, i in use:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, w)), b, lb) for b, lb, w, j in use if j != i and len(w) == len(q)]
        for p, pid, _ in sorted((s, b, lb) for s, b, lb in scored if lb == la)[:keep]:
            window = sorted((s, b) for s, b, lb in scored if lb != la and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(a, pid, r + 1, b, -p, -s) for r, (s, b) in enumerate(window[:keep])]
    return sorted(out)


def result(rows, spark, **settings):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted(tuple(r) for r in mine_negatives(df, **settings).collect())


def vectors(n, dims, seed, close=0.2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, close) for x in rng.choice(rows)[1]] if rows and i % 3 else [rng.gauss(0, 0.5) for _ in range(dims)]
        rows.append((i, [float(np.float32(x)) for x in v], rng.randint(0, 3), 1, 2, 3, "x"))
    return rows


def test_negatives_match_brute_force(spark):
    rows = vectors(400, 19, 1)
    rows += [(1000 + i, rows[3][1], i % 4, 0, 0, 0, "") for i in range(60)]  # ties and copies of every label
    rows += [(10, rows[40][1], 2, 0, 0, 0, ""), rows[20], rows[20], (None, rows[1][1], 0, 0, 0, 0, "")]
    rows += [(2000, None, 0, 0, 0, 0, ""), (2010, rows[1][1], None, 0, 0, 0, ""), (2020, [math.nan] * 19, 0, 0, 0, 0, ""), (2030, [], 0, 0, 0, 0, ""), (2040, [1.0, None], 0, 0, 0, 0, "")]
    rows += [(3000 + i, r[1][:4], r[2], 0, 0, 0, "") for i, r in enumerate(rows[:40])]  # another length
    want = brute(rows)
    assert len(want) > 800
    assert result(rows, spark, every=10, block=64) == want


@pytest.mark.parametrize("close", [0.02, 1.0])
def test_few_rows_of_a_label_and_empty_windows(spark, close):
    rows = [(i, v, 7 if i % 50 == 0 else lb, *rest) for i, v, lb, *rest in vectors(200, 6, 5, close)]
    assert result(rows, spark, every=25, block=32) == brute(rows, 25)


def test_negative_and_zero_scores(spark):
    rows = [(0, [1.0, 0.0], 1, 0, 0, 0, ""), (1, [-1.0, 0.0], 1, 0, 0, 0, ""), (2, [0.0, 1.0], 1, 0, 0, 0, ""), (3, [0.0, 2.0], 2, 0, 0, 0, ""), (4, [-1.0, 0.5], 2, 0, 0, 0, "")]
    assert result(rows, spark) == brute(rows, 100) == [(0, 2, 1, 3, 0, 0)]


def test_nothing(spark):
    assert result([], spark) == []
    assert result([(100, None, 1, 0, 0, 0, "")], spark) == []
    assert result([(100, [1.0], 1, 0, 0, 0, "")], spark) == []


def test_large_components_and_the_limit(spark):
    rows = [(i, [x * 2**12 for x in v], *rest) for i, v, *rest in vectors(150, 5, 8)]
    assert result(rows, spark, every=10, block=50) == brute(rows)
    with pytest.raises(ValueError, match="limit"):
        mine_negatives(spark.createDataFrame([(0, [1e17, 1.0], 1, 0, 0, 0, "")], SCHEMA))


def test_joins_lose_no_pair_whatever_the_threshold():
    rng = np.random.default_rng(3)
    for exact in (True, False):
        q = rng.integers(-90, 91, (300, 37))
        q[50:80] = q[7]
        a = np.concatenate((q[:9], rng.integers(-90, 91, (5, 37))))
        index = BlockIndex(q, np.arange(300), np.zeros(300, "i8"), np.arange(300), exact)
        full = a @ q.T
        for part in (0.9, 0.4, 0.1, 0.0, -0.2, None):
            low = np.full(len(a), -FAR) if part is None else np.ceil(part * (a * a).sum(axis=1)).astype("i8")
            high = np.full(len(a), FAR if part != 0.1 else 60_000)
            i, j, s = index.join(a, low, high, lambda at: np.ones((len(a), len(at)), bool), np.arange(300))
            want = np.nonzero((full >= low[:, None]) & (full <= high[:, None]))
            assert sorted(zip(i, j, s)) == sorted(zip(*want, full[want]))
    assert np.allclose(remaining_norms(q)[:, 0], np.linalg.norm(q, axis=1)) and (remaining_norms(q)[:, -1] == 0).all()
