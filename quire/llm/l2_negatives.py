"""Hard-negative mining by threshold joins on an inverted index with suffix-norm bounds.

Components become integers, ``floor(scale * x)``, dimensions are put in the order of their
energy, and rows are dealt to blocks. A block's index holds, for every step of eight
dimensions, its rows' values there, and every row's norm over the dimensions from that
step on (its suffix norm).

A threshold join finds all rows that score at least ``low`` against an anchor:

* a row whose suffix norm from some step on is below every ``low / |anchor|`` is not read
  there: what it has left can't reach the threshold by itself, so the index omits it;
* partial scores are accumulated step by step, and a pair goes as soon as its partial score
  plus the product of both remaining norms is below ``low`` (or less that product is above
  the window's upper end);
* survivors get their remaining dimensions, so that scores are exact.

An anchor's rows of the same label are wanted down to the fifth: the threshold starts high
and is lowered until five are found, at last to none. Each of these positives opens a
window of scores for rows of other labels, searched likewise: ``low`` starts right below the
positive's score and is lowered, to ``least`` percent at last, until the window holds
enough rows. Windows that are full take no part in later rounds.

Anchors are a stated query set that meets all rows in blocks. In a round, a block's index
and the anchors that ask it are brought together and streamed, the index first, then
anchors in groups, so a task holds one block and one group however many there are; of
every window a block returns only its own first ``negatives`` rows, which hold all of the
block's share in the answer, so neither copies nor very common vectors multiply.

Defined results: rows with a null id or label, or a vector that is null, empty or holds
null or non-finite components, take no part; a score needs two vectors of equal length, so
others aren't compared; rows that repeat an id are separate anchors and candidates, only
the row itself is not its own candidate; equal scores order by id; a positive below zero
has an empty window; an empty table gives no rows; extra columns are not read. A limit,
which raises: dimensions times the largest squared component must stay below 2**56.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.batches import prepared, tasks_for
from quire.plans.materialize import checkpointed

STEP, GROUP = 8, 256
FAR = 2**62
LIMIT = 2**56
#: First thresholds for positives, in parts of the anchor's score with itself; then none.
PARTS = (0.6, 0.3, 0.15)
HIT = "row long, k int, vec_id long, score long, other long"


def usable_rows(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``row, vec_id, label, dims, q``: one row per usable row, numbered."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    there = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull()
    usable = df.where(there).where((F.size(v) > 0) & ~bad)
    q = F.transform(v, lambda x: F.floor(F.lit(scale) * x))
    return usable.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("long").alias("label"), F.size(v).alias("dims"), q.alias("q"),
    )


def shapes(rows: DataFrame) -> dict[int, dict]:
    """``dims`` → number of rows, order of the dimensions by falling energy, and whether
    scores are exact in doubles."""
    flat = rows.select("dims", F.posexplode("q").alias("at", "x"))
    size = F.abs(F.col("x").cast("double"))
    found = flat.groupBy("dims", "at").agg(F.count(F.lit(1)).alias("n"), F.sum(size * size).alias("energy"), F.max(size).alias("top"))
    by: dict[int, list] = {}
    for r in found.collect():  # one row a dimension
        by.setdefault(r.dims, []).append(r)
    out = {}
    for dims, rs in by.items():
        most = dims * max(r.top for r in rs) ** 2
        if most >= LIMIT:
            raise ValueError(f"{dims} dimensions times the largest squared component is {most:.3g}; the limit is 2**56")
        order = [r["at"] for r in sorted(rs, key=lambda r: (-r.energy, r["at"]))]
        out[dims] = {"n": rs[0].n, "order": order, "exact": most < 2**53}
    return out


def remaining_norms(q: np.ndarray) -> np.ndarray:
    """Norms over the dimensions from every step on: ``[rows, steps + 1]``, the last zero."""
    steps = -(-q.shape[1] // STEP)
    squares = np.zeros((len(q), steps + 1))
    for s in reversed(range(steps)):
        part = q[:, s * STEP : (s + 1) * STEP].astype(float)
        squares[:, s] = squares[:, s + 1] + (part * part).sum(axis=1)
    return np.sqrt(squares)


class BlockIndex:
    """The index of one block: values step by step, remaining norms, ids, labels, rows."""

    def __init__(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, exact: bool = True):
        kind = "f8" if exact else "i8"
        self.steps = [np.ascontiguousarray(q[:, s : s + STEP], kind) for s in range(0, q.shape[1], STEP)]
        self.norms, self.ids, self.labels, self.rows, self.kind = remaining_norms(q), ids, labels, rows, kind

    def join(self, a: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: Callable[[np.ndarray], np.ndarray], places: np.ndarray):
        """Pairs ``anchor, place, score`` with ``low <= score <= high`` among ``places`` of the
        block, where ``allowed(places)`` (anchors × places) holds."""
        a = a.astype(self.kind)
        mine = remaining_norms(a)
        slack = 1e-9 * mine[:, 0]  # rounding of the norms; lets too many through, never too few
        whole = np.maximum(mine[:, 0], 1e-300)
        least = (low / whole).min() * (1 - 1e-9) if len(low) else 0.0
        score = np.zeros((len(a), len(places)), self.kind)
        out: list[tuple] = []

        def kept(anchors, at, value, step):
            rest = mine[anchors, step] * self.norms[at, step] + slack[anchors] * self.norms[at, 0]
            return (value + rest >= low[anchors]) & (value - rest <= high[anchors])

        def finish(anchors, at, value, step):
            """Pairs one by one through the remaining steps."""
            while True:
                ok = kept(anchors, at, value, step)
                anchors, at, value = anchors[ok], at[ok], value[ok]
                if step == len(self.steps) or not len(at):
                    break
                value = value + np.einsum("pk,pk->p", a[anchors, step * STEP : (step + 1) * STEP], self.steps[step][at])
                step += 1
            value = value.astype("i8")
            ok = (value >= low[anchors]) & (value <= high[anchors])
            out.append((anchors[ok], at[ok], value[ok]))

        for step, values in enumerate(self.steps):
            # Rows that the index omits from here on; their pairs wait for verification.
            listed = self.norms[places, step] >= least
            if not listed.all():
                if step:
                    alive = allowed(places[~listed])
                    i, j = np.nonzero(alive)
                    finish(i, places[~listed][j], score[:, ~listed][i, j], step)
                places, score = places[listed], score[:, listed]
            if not len(places):
                break
            score += a[:, step * STEP : (step + 1) * STEP] @ values[places].T
            rest = mine[:, step + 1, None] * self.norms[None, places, step + 1] + slack[:, None] * self.norms[None, places, 0]
            alive = (score + rest >= low[:, None]) & (score - rest <= high[:, None]) & allowed(places)
            if 16 * np.count_nonzero(alive) < alive.size or step + 1 == len(self.steps):
                i, j = np.nonzero(alive)
                finish(i, places[j], score[i, j], step + 1)
                break
            some = alive.any(axis=0)
            places, score = places[some], score[:, some]
        return tuple(np.concatenate(x) if out else np.zeros(0, "i8") for x in (zip(*out) if out else ((), (), ())))

    def hits(self, rows, labels, q, windows, same: bool, keep: int) -> pd.DataFrame:
        """The block's first ``keep`` rows of every window: ``windows`` is a list of lists
        ``(k, high, low)``, one an anchor."""
        found = []
        low = np.array([min(w[2] for w in ws) for ws in windows], "i8")
        high = np.array([max(w[1] for w in ws) for ws in windows], "i8")
        # Anchors of one label meet its rows alone; for other labels a mask will do.
        for group in [np.flatnonzero(labels == x) for x in np.unique(labels)] if same else [np.arange(len(rows))]:
            places = np.flatnonzero(self.labels == labels[group[0]]) if same else np.arange(len(self.ids))

            def allowed(at, group=group):
                return rows[group][:, None] != self.rows[at][None] if same else labels[group][:, None] != self.labels[at][None]

            i, at, score = self.join(q[group], low[group], high[group], allowed, places)
            found.append((group[i], at, score))
        i, at, score = (np.concatenate(x) for x in zip(*found))
        parts = []
        for slot in range(max(map(len, windows))):
            mine = np.array([ws[slot] if slot < len(ws) else (-1, -FAR, FAR) for ws in windows], "i8")
            ok = (score >= mine[i, 2]) & (score <= mine[i, 1])
            a, b, s = i[ok], at[ok], score[ok]
            order = np.lexsort((self.rows[b], self.ids[b], -s, a))
            a, b, s = a[order], b[order], s[order]
            first = np.searchsorted(a, a)  # the place of the anchor's first pair
            ok = np.arange(len(a)) - first < keep
            a, b, s = a[ok], b[ok], s[ok]
            parts.append(pd.DataFrame({"row": rows[a], "k": mine[a, 0].astype("i4"), "vec_id": self.ids[b], "score": s, "other": self.rows[b]}))
        return pd.concat(parts)


def build_index(rows: DataFrame, shape: dict[int, dict], block: int) -> DataFrame:
    """``dims, block`` and the block's arrays as bytes, dimensions in the order of ``shape``."""
    blocks = F.create_map(*[F.lit(x) for d, s in shape.items() for x in (d, -(-s["n"] // block))])

    def build(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        q = np.stack(f["q"].to_numpy()).astype("i8")[:, shape[int(key[0])]["order"]]
        one = lambda x: [np.ascontiguousarray(x, "i8").tobytes()]
        return pd.DataFrame({"dims": [int(key[0])], "block": [int(key[1])], "ids": one(f["vec_id"]), "labels": one(f["label"]), "rows": one(f["row"]), "values": one(q)})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), blocks[F.col("dims")]))
    return dealt.groupBy("dims", "block").applyInPandas(build, "dims int, block long, ids binary, labels binary, rows binary, values binary")


def threshold_join(index: DataFrame, asks: DataFrame, shape: dict[int, dict], same: bool, keep: int) -> DataFrame:
    """``asks(row, label, dims, q, windows)`` against every block: each block's first ``keep``
    rows of every window, as ``row, k, vec_id, score, other`` (the found row)."""
    # Arrays of one index block come first in its stream, then the anchors that ask it.
    none = lambda kind, *names: [F.lit(None).cast(kind).alias(x) for x in names]
    last = F.create_map(*[F.lit(x) for d, s in shape.items() for x in (d, -(-s["n"] // s["block"]) - 1)])[F.col("dims")]
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))
    left = index.select("dims", "block", F.lit(0).alias("kind"), "ids", "labels", "rows", "values", *none("long", "row", "label"), *none("array<long>", "q"), *none("array<struct<k:int,high:long,low:long>>", "windows"))
    right = asks.select("dims", every_block.alias("block"), F.lit(1).alias("kind"), *none("binary", "ids", "labels", "rows", "values"), "row", "label", "q", "windows")
    tasks = tasks_for(index.sparkSession)
    streamed = left.unionAll(right).repartition(tasks, "dims", "block").sortWithinPartitions("dims", "block", "kind")

    def run(batches) -> Iterator[pd.DataFrame]:
        here, waiting = None, []

        def answer():
            at, order = here[1], shape[here[0]]["order"]
            rows, labels = (np.array([w[x] for w in waiting], "i8") for x in (0, 1))
            q = np.stack([w[2] for w in waiting]).astype("i8")[:, order]
            return at.hits(rows, labels, q, [[(w["k"], w["high"], w["low"]) for w in ws] for *_, ws in waiting], same, keep)

        for frame in batches:
            for r in frame.itertuples(index=False):
                if r.kind == 0:
                    if waiting:
                        yield answer()
                        waiting = []
                    ids, labels, rows, q = (np.frombuffer(x, "i8") for x in (r.ids, r.labels, r.rows, r.values))
                    here = (r.dims, BlockIndex(q.reshape(-1, r.dims), ids, labels, rows, shape[r.dims]["exact"]))
                else:
                    waiting.append((r.row, r.label, r.q, r.windows))
                    if len(waiting) == GROUP:
                        yield answer()
                        waiting = []
        if waiting:
            yield answer()

    return streamed.mapInPandas(run, HIT)


def lowered_until_full(index, anchors: DataFrame, windows: DataFrame, lows: list[Column], shape, same: bool, keep: int) -> DataFrame:
    """``windows(row, k, high, …)`` and one lower end a round → the first ``keep`` rows of every
    window: ``row, k, rank, vec_id, score, other``. Full windows leave after their round."""
    best = Window.partitionBy("row", "k").orderBy(F.desc("score"), "vec_id", "other")
    done: list[DataFrame] = []
    for i, low in enumerate(lows):
        if windows.isEmpty():
            break
        asked = windows.groupBy("row").agg(F.collect_list(F.struct("k", "high", low.cast("long").alias("low"))).alias("windows"))
        asks = anchors.join(asked, "row")
        found = threshold_join(index, asks, shape, same, keep).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
        found = checkpointed(found, "negatives-round")
        if i + 1 == len(lows):
            done.append(found)
            break
        full = found.where(F.col("rank") == keep).select("row", "k")
        done.append(found.join(full, ["row", "k"], "left_semi"))
        windows = checkpointed(windows.join(full, ["row", "k"], "left_anti"), "negatives-open")
    empty = anchors.sparkSession.createDataFrame([], f"{HIT}, rank int")
    return reduce(DataFrame.unionByName, done, empty)


def mine_negatives(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: float = 256.0,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    steps: int = 4,
    block: int = 4096,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each
    of the first ``positives`` rows of an anchor's label, the first ``negatives`` rows of
    other labels that score between ``least`` and 100 percent of it. ``steps``: rounds in which
    a window's lower end comes down."""
    spark = prepared(df.sparkSession)
    rows = checkpointed(usable_rows(df, id_col, vector_col, label_col, scale), "mined-rows")
    shape = shapes(rows)
    if not shape:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for s in shape.values():
        s["block"] = block
    index = checkpointed(build_index(rows, shape, block), "mined-index")
    anchors = rows.where(F.col("vec_id") % every == 0)

    itself = F.aggregate("q", F.lit(0).cast("long"), lambda t, x: t + x * x)
    wanted = anchors.select("row", F.lit(0).alias("k"), F.lit(FAR).alias("high"), itself.alias("itself"))
    lows = [F.ceil(F.col("itself") * F.lit(part)) for part in PARTS] + [F.lit(-FAR)]
    near = lowered_until_full(index, anchors, wanted, lows, shape, True, positives)
    near = checkpointed(near.select("row", F.col("rank").alias("k"), F.col("vec_id").alias("positive_id"), F.col("score").alias("high")), "positives")

    ends = [100 - (100 - least) * (i + 1) / steps for i in range(steps - 1)]
    lows = [F.ceil(F.col("high") * F.lit(end / 100)) for end in ends] + [F.expr(f"(high * {least} + 99) div 100")]
    hard = lowered_until_full(index, anchors, near.where("high >= 0").select("row", "k", "high"), lows, shape, False, negatives)
    named = near.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return hard.join(named, ["row", "k"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
        F.col("high").alias("positive_score"), F.col("score").alias("negative_score"),
    )
