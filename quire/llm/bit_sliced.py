"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers and indexed in blocks of at most about ``block`` rows:
for every component and every bit of ``x - low`` one bitmap over the block's rows (a
slice). The score of a query against a whole block is bitmap arithmetic: each set bit of
a query component adds that component's slices, shifted; a negative query component adds
the complemented slices instead (``-q * u = q * (2**bits - 1 - u) - constant``), so all
terms are non-negative. Carry-save adders reduce the bitmaps of equal weight three at a
time to one sum and one carry bitmap until one slice is left for every weight.

The top rows are then taken from the most significant slice downward: rows known to be
in the answer, and candidates; where a slice has more candidates than are missing the
search narrows to them, else they are all taken. The candidates left after the last
slice have equal scores: this boundary is resolved exactly, by the smaller id.

Every query block meets every index block by an equi-join on the block numbers, and each
pair of blocks returns at most ``k`` rows a query, so partial answers, not scores, are
shuffled.

Defined results: vectors that are null, empty, or hold null or non-finite components take
no part, neither do null ids; vectors of each length have an index of their own, since a
product needs two of one length; rows that repeat an id are separate queries and separate
candidates, and a query's own row is never its candidate; equal scores order by id; an
empty table gives no rows. Limits, which raise: components after scaling stay below 2**62,
and a score that is returned fits a long.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.materialize import checkpointed

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
LIMIT = 2**62


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``vec_id, q``: ``floor(scale * x)`` of every component, usable vectors only."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where((F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)))
    q = F.transform(v, lambda x: F.floor(F.lit(scale) * x))
    return usable.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.size(v).alias("dims"), q.alias("q"))


def slice_block(u: np.ndarray, bits: int) -> np.ndarray:
    """Unsigned ``u[rows, dims]`` → bitmaps ``[dims, bits, words]``."""
    rows = u.shape[0]
    planes = (u.T[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    packed = np.packbits(planes.astype("u1"), axis=2, bitorder="little")
    words = -(-rows // 64)
    out = np.zeros((*packed.shape[:2], 8 * words), "u1")
    out[:, :, : packed.shape[2]] = packed
    return out.view("u8")


def add_slices(by_weight: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Sum of bitmaps given by weight (log2) → one slice per weight, least first. Each
    entry is a stack ``[n, words]``."""
    out, weight = [], 0
    while by_weight:
        stacks = by_weight.pop(weight, [])
        level = np.concatenate(stacks) if stacks else np.zeros((0, words), "u8")
        while len(level) > 1:
            if len(level) == 2:
                a, b = level
                carry, level = (a & b)[None], (a ^ b)[None]
            else:
                n = len(level) // 3
                a, b, c = level[:n], level[n : 2 * n], level[2 * n : 3 * n]
                half = a ^ b
                carry = (a & b) | (half & c)
                level = np.concatenate((half ^ c, level[3 * n :]))
            by_weight.setdefault(weight + 1, []).append(carry)
        out.append(level[0] if len(level) else np.zeros(words, "u8"))
        weight += 1
    return out


def score_slices(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Slices of ``sum |q| * (u or its complement)`` over the rows of a block."""
    dims, bits, words = slices.shape
    size = np.abs(query)
    flip = np.where(query < 0, ONES, np.uint64(0))
    by_weight: dict[int, list[np.ndarray]] = {}
    for shift in range(int(size.max()).bit_length() if dims else 0):
        on = np.flatnonzero(size >> shift & 1)
        if len(on):
            terms = slices[on] ^ flip[on][:, None, None]
            for b in range(bits):
                by_weight.setdefault(shift + b, []).append(terms[:, b])
    return add_slices(by_weight, words)


def top_rows(slices: list[np.ndarray], valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the rows surely among the ``k`` highest, and of the tied rows from
    which the rest is to be taken."""
    count = lambda x: int(np.bitwise_count(x).sum())
    sure, tied = np.zeros_like(valid), valid
    missing = k
    if count(valid) <= k:
        return valid, sure
    for s in reversed(slices):
        high = tied & s
        n = count(high)
        if n >= missing:
            tied = high
        else:
            sure, missing = sure | high, missing - n
            tied = tied & ~s
    return sure, tied


def row_numbers(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view("u1"), bitorder="little"))


def build_index(vectors: DataFrame, shape: dict[int, tuple[int, int, int]]) -> DataFrame:
    """One row per block: ids (ascending), the rows they stand for, and the slices of every
    component. ``shape``: by length the number of blocks, the least value and its bits."""
    blocks = F.create_map(*[F.lit(x) for d, (n, _, _) in shape.items() for x in (d, n)])[F.col("dims")]

    def build(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["vec_id", "row"])
        _, low, bits = shape[int(key[0])]
        u = np.stack(f["q"].to_numpy()).astype("i8") - low
        return pd.DataFrame({
            "dims": [int(key[0])], "block": [int(key[1])], "ids": [f["vec_id"].to_numpy().astype("i8").tobytes()],
            "rows": [f["row"].to_numpy().astype("i8").tobytes()], "slices": [slice_block(u, bits).tobytes()],
        })

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), blocks))
    return dealt.groupBy("dims", "block").applyInPandas(build, "dims int, block long, ids binary, rows binary, slices binary")


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: float = 256.0,
    every: int = 50,
    block: int = 8192,
    queries_per_block: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` highest integer inner products of
    every row whose id is divisible by ``every``, against all other rows."""
    vectors = checkpointed(quantised(df, id_col, vector_col, scale), "quantised")
    ends = vectors.select("dims", F.array_min("q").alias("low"), F.array_max("q").alias("high"))
    by_length = ends.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    if not by_length:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top = {r.dims: max(abs(r.low), abs(r.high)) for r in by_length}
    if max(top.values()) >= LIMIT:
        raise ValueError(f"components of up to {max(top.values())} after scaling; they must stay below 2**62")
    shape = {r.dims: (-(-r.n // block), r.low, max(1, (r.high - r.low).bit_length())) for r in by_length}
    wide = {d for d, x in top.items() if 4 * d * x * x >= LIMIT}  # sums that may leave 64 bits on the way
    groups = {r.dims: -(-r.n // (every * queries_per_block)) or 1 for r in by_length}
    of_length = lambda values: F.create_map(*[F.lit(x) for d, v in values.items() for x in (d, v)])[F.col("dims")]
    upto = lambda values: F.sequence(F.lit(0).cast("long"), of_length(values).cast("long") - 1)
    index = checkpointed(build_index(vectors, shape), "slices")
    asked = vectors.where(F.col("vec_id") % every == 0).withColumn("of", F.pmod(F.xxhash64("row", F.lit(1)), of_length(groups)).cast("long"))
    left = index.select("dims", "block", F.explode(upto(groups)).alias("group"), "ids", "rows", "slices")
    right = asked.select("dims", F.explode(upto({d: n for d, (n, _, _) in shape.items()})).alias("at"), "of", "row", "vec_id", "q")

    def search(key: tuple, index_rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        for entry in index_rows.itertuples():
            dims = int(entry.dims)
            _, low, bits = shape[dims]
            ids, numbers = np.frombuffer(entry.ids, "i8"), np.frombuffer(entry.rows, "i8")
            words = -(-len(ids) // 64)
            slices = np.frombuffer(entry.slices, "u8").reshape(dims, bits, words)
            everyone = np.zeros(8 * words, "u1")
            filled = np.packbits(np.ones(len(ids), "u1"), bitorder="little")
            everyone[: len(filled)] = filled
            everyone = everyone.view("u8")
            place = {int(numbers[at]): int(at) for at in np.flatnonzero(ids % every == 0)}
            for row, query_id, q in zip(queries["row"], queries["vec_id"], queries["q"]):
                q = np.asarray(q, "i8")
                valid = everyone.copy()
                at = place.get(int(row))
                if at is not None:
                    valid[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
                total = score_slices(slices, q)
                sure, tied = top_rows(total, valid, k)
                found = row_numbers(sure)
                found = np.concatenate((found, row_numbers(tied)[: k - len(found)]))
                # The rows' scores from their bits; what the offsets added comes off.
                whole = q.astype(object) if dims in wide else q
                value = np.zeros(len(found), whole.dtype)
                for w, s in enumerate(total):
                    value += ((s[found // 64] >> (found % 64).astype("u8")) & np.uint64(1)).astype("i8").astype(whole.dtype) << w
                value += low * int(whole.sum()) - int(-whole[q < 0].sum()) * ((1 << bits) - 1)
                if dims in wide and any(abs(v) >= 2**63 for v in value):
                    raise OverflowError("a score does not fit a long")
                out += [(int(row), int(query_id), int(ids[r]), int(v)) for r, v in zip(found, value)]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"]).astype("int64")

    pairs = left.groupBy("dims", "block", "group").cogroup(right.groupBy("dims", "at", "of"))
    found = pairs.applyInPandas(search, "row long, query_id long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
