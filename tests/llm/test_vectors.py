"""Operators on embeddings against brute force."""

import math
import random

import numpy as np
import pytest

from quire.llm.bit_sliced import add_slices, score_slices, slice_block, top_k
from quire.llm.components import connected_components
from quire.llm.pq_neardup import Settings, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score long, x string"


def vectors(n=160, dims=6, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i % 4 and rows:
            base = rng.choice(rows)[1]
            v = [float(np.float32(x + rng.gauss(0, 0.04))) for x in base]
        else:
            v = [float(np.float32(rng.gauss(0, 0.4))) for _ in range(dims)]
        rows.append((i, v, rng.choice([0, 0, 0, 1, 2]), 1, 2, "c"))
    return rows


def odd_rows(dims=6):
    z = [0.0] * dims
    return [
        (900, None, 0, 0, 0, ""), (901, z, 0, 0, 0, ""), (902, [], 0, 0, 0, ""), (903, [1.0, None] + z[2:], 0, 0, 0, ""),
        (904, [math.nan] + z[1:], 0, 0, 0, ""), (905, [math.inf] + z[1:], 0, 0, 0, ""), (950, [1.0, 2.0], 0, 0, 0, ""),
        (906, [1.0] * dims, None, 0, 0, ""), (907, [1.0] * dims, None, 0, 0, ""), (None, [1.0] * dims, 0, 0, 0, ""),
    ]


def fit(v, dims=6):
    return v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)


def test_top_k_matches_brute_force(spark):
    rows = vectors() + odd_rows() + [(50, vectors()[50][1], 0, 0, 0, ""), (50, vectors()[7][1], 0, 0, 0, "")]
    rows += [(1000 + i, vectors()[3][1], 0, 0, 0, "") for i in range(9)]  # ties
    rows += [(2000 + i, r[1][:3], 0, 0, 0, "") for i, r in enumerate(vectors(40, 6, 4))]  # another length
    got = [tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA).repartition(4), every=10, block=16, queries_per_block=3).collect()]
    good = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    usable = [(at, r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]]) for at, r in enumerate(rows) if r[0] is not None and good(r[1])]
    want = []
    for at, q, v in usable:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for other, i, w in usable if other != at and len(w) == len(v))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
    assert sorted(got) == sorted(want)
    assert sum(g[0] == 50 for g in got) == 15


def test_top_k_of_large_components(spark):
    for factor, one in ((1e6, None), (1.0, 1e12), (1.0, 1e13)):
        rows = [(i, [x * factor for x in v], *rest) for i, v, *rest in vectors(60, 4, 9)]
        if one:
            rows[13][1][2] = one
        got = [tuple(r) for r in top_k(spark.createDataFrame(rows, SCHEMA), every=10, block=16).collect()]
        q = {r[0]: [math.floor(256 * float(np.float32(x))) for x in r[1]] for r in rows}
        want = []
        for a in range(0, 60, 10):
            scored = sorted((-sum(x * y for x, y in zip(q[a], q[b])), b) for b in q if b != a)
            want += [(a, k + 1, i, -s) for k, (s, i) in enumerate(scored[:5])]
        assert sorted(got) == sorted(want)
    with pytest.raises(ValueError, match="2\\*\\*62"):
        top_k(spark.createDataFrame([(0, [1e17, 1.0], 0, 0, 0, ""), (1, [1.0, 1.0], 0, 0, 0, "")], SCHEMA))


def test_top_k_small_and_empty(spark):
    assert top_k(spark.createDataFrame([], SCHEMA)).count() == 0
    assert top_k(spark.createDataFrame(odd_rows()[:6], SCHEMA)).where("score is null").count() == 0
    three = spark.createDataFrame([(i, [0.1 * i, -0.2], 0, 0, 0, "") for i in range(3)], SCHEMA)
    assert sorted((r.query_id, r.rank) for r in top_k(three).collect()) == [(0, 1), (0, 2)]


def test_slice_arithmetic_is_integer_arithmetic():
    rng = np.random.default_rng(1)
    for _ in range(20):
        rows, dims, bits = int(rng.integers(1, 150)), int(rng.integers(1, 9)), int(rng.integers(1, 8))
        u, q = rng.integers(0, 1 << bits, (rows, dims)), rng.integers(-40, 41, dims)
        slices = score_slices(slice_block(u, bits), q)
        total = sum((np.unpackbits(s.view("u1"), bitorder="little")[:rows].astype("i8") << w) for w, s in enumerate(slices)) if slices else np.zeros(rows, "i8")
        assert (total - int(-q[q < 0].sum()) * ((1 << bits) - 1) == u @ q).all()
    assert add_slices({}, 3) == []


@pytest.mark.parametrize("settings", [Settings(threshold=0.98), Settings(threshold=0.9, list_rows=8, tile=4, codes=3, subspaces=4)])
def test_links_match_brute_force(spark, settings):
    """Every link is found: the probes are sufficient and the code bound is safe."""
    rows = vectors(240, seed=3) + odd_rows()
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA), settings=settings).collect()
    ids = [r[0] for r in rows if r[0] is not None]
    good = [r for r in rows if r[0] is not None and fit(r[1]) and any(r[1]) and r[2] is not None]
    unit = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in good}
    label = {r[0]: r[2] for r in good}
    near = {i: {j for j in unit if j != i and label[i] == label[j] and unit[i] @ unit[j] >= settings.threshold} for i in unit}
    component = {i: i for i in ids}
    for _ in ids:
        for i in near:
            component[i] = min([component[i], *(component[j] for j in near[i])])
    want = sorted((i, len(near.get(i, ())), component[i], component[i] == i) for i in ids)
    assert sorted(tuple(r) for r in out) == want
    assert sum(len(x) for x in near.values()) > 50


def test_links_of_repeated_ids_and_nothing(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    same = [(1, [1.0, 0.0], 5, 0, 0, ""), (1, [1.0, 0.0], 5, 0, 0, ""), (2, [1.0, 0.0], 5, 0, 0, ""), (3, [1.0, 0.0], 6, 0, 0, "")]
    out = sorted(tuple(r) for r in near_duplicates(spark.createDataFrame(same, SCHEMA)).collect())
    assert out == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    none = near_duplicates(spark.createDataFrame(odd_rows()[:2], SCHEMA)).collect()
    assert sorted(tuple(r) for r in none) == [(900, 0, 900, True), (901, 0, 901, True)]


def test_links_of_other_lengths_and_of_the_usable_row(spark):
    """Lengths link among themselves; an id's row with a null label or vector gives way."""
    rows = [(i, [float(i % 3), 1.0, 0.5][: 2 + i % 2], 5, 0, 0, "") for i in range(24)]
    rows += [(100, [1.0, 0.0], None, 0, 0, ""), (100, None, 5, 0, 0, ""), (100, [0.0, 1.0], 5, 0, 0, "")]
    out = {r.vec_id: r for r in near_duplicates(spark.createDataFrame(rows, SCHEMA), settings=Settings(list_rows=4, tile=3)).collect()}
    of = {i: tuple(v) for i, v, *_ in rows[:24]} | {100: (0.0, 1.0)}
    for i, v in of.items():
        same = [j for j, w in of.items() if w == v]
        assert out[i].n_links == len(same) - 1 and out[i].component_id == min(same)


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 7) for i in range(7)]
    edges += [(5, 5), (None, 3), (41, 40), (-3, 41)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: -3 for i in [*range(42), -3]} | {100 + i: 100 for i in range(30)} | {200 + i: 200 for i in range(7)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
