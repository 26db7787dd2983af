"""Embedding whitening from a polarisation covariance.

Entries become integers, ``x = floor(scale * c) + offset``. With ``n`` vectors and the sums
``S`` of every dimension, ``y = n * x - S`` is the centred value times ``n``, an exact integer.
One pass adds up ``y_i ** 2`` for every dimension and ``(y_i + y_j) ** 2`` for every pair of
dimensions, without rounding: values are cut in 25-bit limbs, the limbs' products are summed
in 64-bit integers over at most 2,048 rows at a time, and Spark adds those sums as decimals.
The difference ``((y_i + y_j)² - y_i² - y_j²) / 2`` of the variances is the cross-covariance
(the polarisation identity); all of them are assembled on the driver, one matrix of
dimension squared, for ``eigh``. A last pass projects every vector on the first components.

Tasks return one row a pair and limb; nothing but sums and the matrix reaches the driver.

Defined results: vectors that are null or hold null or non-finite entries are dropped, and
so are empty ones, which have no dimension; vectors of one length are a fit list of their
own (their covariances with other lengths don't exist); rows that repeat an id, and rows
with a null id, count and are returned one by one; a component without variance
(an eigenvalue that is zero to double precision) is not returned, since nothing is left to
scale, and components are numbered among those returned; an empty table gives no rows;
extra columns are not read. ``deviation`` is null where it doesn't fit a long. Limits, which
raise: entries of up to 2**40 after scaling, and ``n`` times the range of a dimension below
2**61.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import prepared
from quire.plans.materialize import checkpointed

LIMB, BLOCK = 25, 2048
LARGEST = 2**40
SUMS = "dims int, item int, power int, part decimal(38,0)"


def whole_entries(df: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """``vec_id, dims, x``: the entries as longs, usable vectors only."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    far = F.exists(v, lambda c: F.abs(F.lit(scale) * c) > float(LARGEST))
    usable = df.where(F.col(vector_col).isNotNull()).where((F.size(v) > 0) & ~bad)
    x = F.when(far, F.raise_error(F.lit(f"whitening takes entries of up to {LARGEST} after scaling"))).otherwise(
        F.transform(v, lambda c: F.floor(F.lit(scale) * c) + F.lit(offset))
    )
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dims"), x.alias("x"))


def stacks(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``dims, rows' places, values[rows, dims]`` of a batch, length by length, in blocks."""
    lists = batch.column(column)
    ends = np.asarray(lists.offsets)
    flat = np.asarray(lists.values)
    size = np.diff(ends)
    for dims in np.unique(size):
        at = np.flatnonzero(size == dims)
        for i in range(0, len(at), BLOCK):
            rows = at[i : i + BLOCK]
            yield int(dims), rows, flat[ends[rows][:, None] + np.arange(dims)]


def _totals(kept: dict) -> Iterator[pa.RecordBatch]:
    import decimal

    number = pa.decimal128(38, 0)
    for dims, parts in kept.items():
        for power, values in parts.items():
            items = np.arange(len(values), dtype="i4")
            n = len(items)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, dims, "i4")), pa.array(items), pa.array(np.full(n, power, "i4")), pa.array([decimal.Decimal(int(v)) for v in values], number)],
                names=["dims", "item", "power", "part"],
            )


@dataclass(frozen=True)
class Fit:
    """Of the vectors of one length: their number, sums, covariance of ``x`` (divisor n), and
    the components that are returned, one a column."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


def first_sums(vectors: DataFrame) -> dict[int, list[tuple[int, int, int, int]]]:
    """``dims`` → for every dimension ``n, S, least, largest``."""
    flat = vectors.select("dims", F.posexplode("x").alias("item", "value"))
    value = F.col("value")
    found = flat.groupBy("dims", "item").agg(
        F.count(F.lit(1)).alias("n"), F.sum(value.cast("decimal(20,0)")).alias("s"), F.min(value).alias("low"), F.max(value).alias("high")
    )
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r.dims, r.item)):  # one row a dimension
        out.setdefault(r.dims, []).append((r.n, int(r.s), r.low, r.high))
    for dims, rows in out.items():
        n = rows[0][0]
        if any(n * (high - low) >= 2**61 for _, _, low, high in rows):
            raise ValueError(f"{n} vectors of {dims} entries: n times the range of an entry must stay below 2**61")
    return out


def centred(x: np.ndarray, n: int, sums: np.ndarray, base: np.ndarray) -> np.ndarray:
    """``n * x - S`` without overflow; ``base`` is a whole number near the mean."""
    return n * (x - base) - sums


def polarised(y: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """Limb by limb, the sums over rows of ``y_i ** 2`` for all dimensions, then of
    ``(y_i + y_j) ** 2`` for all pairs ``i < j``: ``power, sums`` that count ``2 ** (25 * power)``."""
    dims = y.shape[1]
    limbs = -(-bits // LIMB)
    mask = (1 << LIMB) - 1
    parts = np.zeros((2 * limbs - 1, dims * (dims + 1) // 2), "i8")
    at = 0
    for i in range(-1, dims - 1):
        z = np.abs(y if i < 0 else y[:, i : i + 1] + y[:, i + 1 :])
        cut = [z & mask if limbs > 1 else z, *((z >> LIMB * k) & mask for k in range(1, limbs))]
        to = at + z.shape[1]
        for a in range(limbs):
            for b in range(a, limbs):
                # Twice a mixed product of 50 bits over 2,048 rows stays below 2**62.
                parts[a + b, at:to] += np.einsum("rk,rk->k", cut[a], cut[b]) * (1 if a == b else 2)
        at = to
    yield from enumerate(parts)


def fits(vectors: DataFrame, most: int) -> dict[int, Fit]:
    first = first_sums(vectors)
    settings = {}
    for dims, rows in first.items():
        n = rows[0][0]
        base = [s // n for _, s, _, _ in rows]
        rest = [s - n * b for (_, s, _, _), b in zip(rows, base)]
        # Of the sum of two centred values.
        bits = max(1, max(n * (high - low) for _, _, low, high in rows).bit_length() + 1)
        settings[dims] = (n, np.array(rest), np.array(base), bits)

    def run(batches):
        kept: dict[int, dict[int, np.ndarray]] = {}
        for batch in batches:
            for dims, _, x in stacks(batch):
                n, rest, base, bits = settings[dims]
                mine = kept.setdefault(dims, {})
                for power, sums in polarised(centred(x, n, rest, base), bits):
                    mine[power] = mine[power] + sums.astype(object) if power in mine else sums.astype(object)
        yield from _totals(kept)

    total: dict[int, dict[int, int]] = {dims: {} for dims in first}
    parts = vectors.select("x").mapInArrow(run, SUMS)
    for r in parts.groupBy("dims", "item", "power").agg(F.sum("part").alias("part")).toLocalIterator():  # dims squared rows
        mine = total[r.dims]
        mine[r.item] = mine.get(r.item, 0) + (int(r.part) << LIMB * r.power)
    return {dims: _fit(dims, first[dims], total[dims], most) for dims in sorted(first)}


def _fit(dims: int, first: list, total: dict[int, int], most: int) -> Fit:
    n = first[0][0]
    exact = [[0] * dims for _ in range(dims)]
    for i in range(dims):
        exact[i][i] = total[i]
    for item, (i, j) in enumerate(combinations(range(dims), 2), dims):
        exact[i][j] = exact[j][i] = (total[item] - total[i] - total[j]) // 2
    cube = n**3  # y holds n twice, the divisor once more
    v = np.array([[x / cube for x in row] for row in exact])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = values > values[0] * dims * np.finfo(float).eps if values[0] > 0 else np.zeros(dims, bool)
    keep = min(most, int(real.sum()))
    vectors = vectors[:, :keep].copy()
    for k in range(keep):  # one sign for all rows: the largest entry is positive
        vectors[:, k] *= np.sign(vectors[np.argmax(np.abs(vectors[:, k])), k])
    return Fit(n, tuple(s for _, s, _, _ in first), v, values[:keep].copy(), vectors)


def _deviation(y: np.ndarray) -> np.ndarray:
    """Exact sums of squares over a row; None beyond a long."""
    rough = (y.astype(float) ** 2).sum(axis=1)
    out = (y * y).sum(axis=1).astype(object)
    for r in np.flatnonzero(rough > 2.0**62):
        exact = sum(int(v) ** 2 for v in y[r])
        out[r] = exact if exact < 2**63 else None
    return out


def _projected(vectors: DataFrame, found: dict[int, Fit]) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for dims, rows, x in stacks(batch):
                f = found[dims]
                if not len(f.values):
                    continue
                base = np.array([s // f.n for s in f.sums])
                y = centred(x, f.n, np.array([s - f.n * (s // f.n) for s in f.sums]), base)
                w = (y / f.n) @ (f.vectors / np.sqrt(f.values))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), pa.array(np.full(len(rows), dims, "i4")), pa.array(_deviation(y), pa.int64()), pa.array(list(w), pa.list_(pa.float64()))],
                    names=["vec_id", "dims", "deviation", "w"],
                )

    return vectors.select("vec_id", "x").mapInArrow(run, "vec_id long, dims int, deviation long, w array<double>")


def identity_errors(projected: DataFrame, found: dict[int, Fit]) -> dict[int, float]:
    """``dims`` → the largest absolute entry of the whitened rows' covariance less the
    identity, measured on the rows."""
    keep = max((len(f.values) for f in found.values()), default=0)
    w = lambda a: F.get("w", F.lit(a))
    pairs = [(a, b) for a in range(keep) for b in range(a, keep)]
    means = [F.avg(w(a)).alias(f"m{a}") for a in range(keep)]
    products = [F.avg(w(a) * w(b)).alias(f"p{a}_{b}") for a, b in pairs]
    out: dict[int, float] = {}
    if not pairs:
        return out
    for r in projected.groupBy("dims").agg(*means, *products).collect():  # one row a length
        mine = len(found[r.dims].values)
        out[r.dims] = max(abs(r[f"p{a}_{b}"] - r[f"m{a}"] * r[f"m{b}"] - (a == b)) for a, b in pairs if b < mine)
    return out


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0, offset: int = 100_000, components: int = 8) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every
    usable vector and its first ``components`` components."""
    spark = prepared(df.sparkSession)
    vectors = checkpointed(whole_entries(df, id_col, vector_col, scale, offset), "entries")
    found = fits(vectors, components)
    projected = checkpointed(_projected(vectors, found), "whitened")
    errors = identity_errors(projected, found)
    rows = [
        (dims, k, f.n, float(f.values[k] / np.trace(f.covariance)), errors[dims])
        for dims, f in found.items() for k in range(len(f.values))
    ]
    # One row a length and component.
    of = spark.createDataFrame(rows, "dims int, place int, n long, explained double, identity_error double")
    flat = projected.select("vec_id", "dims", "deviation", F.posexplode("w").alias("place", "whitened"))
    return flat.join(F.broadcast(of), ["dims", "place"]).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), "n", "deviation", "whitened", "explained", "identity_error"
    )
