"""Embedding near-duplicates with product quantisation.

1. *Index.* A coarse codebook (k-means on a bounded, hashed sample) splits the unit
   vectors into inverted lists by label and nearest centroid; the residual is cut in
   subspaces, each coded by the nearest of ``codes`` subcentroids. Every vector is
   indexed, with the length of what its code misses.
2. *Probes.* A vector within distance r of x can lie in another list only if x is within
   r of the plane between the two centroids. x probes every list for which that holds:
   the probes are sufficient, none is missed.
3. *Table lookup.* Inside a list, the distance of a probe to each code is a sum of table
   entries (asymmetric distance). Minus what the code misses it is a lower bound of the
   true distance (triangle inequality), so a pair beyond the bound is discarded.
4. *Rerank.* Survivors are compared by exact cosine in double precision.

Recall is therefore that of brute force. Lists are cut into tiles of bounded size, both
ways, so a hot list is many units of work; a unit returns a count for each probe and the
edges of a spanning forest, never its pairs.

Vectors of each length have a codebook of their own and meet only each other.

Defined results: vectors that are null, zero, or hold null or non-finite components, and
rows with a null label, link with nothing; a repeated ``vec_id`` counts once (the smallest
label and vector of its usable rows), a null one not at all; ties of centroids
go to the lower number; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.batches import sampled
from quire.llm.components import connected_components
from quire.plans.materialize import checkpointed


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.98
    sample: int = 20_000  # vectors the codebooks are fitted on
    list_rows: int = 2048  # aimed at, per list
    most_lists: int = 1024  # bounds the coarse codebook
    subspaces: int = 8
    codes: int = 16
    tile: int = 1024  # rows of a list, and of its probes, in one unit of work


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(1)[None] - 2 * x @ centres.T).argmin(1)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows; an empty cell keeps its centre."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype("i8")].copy()
    for _ in range(rounds):
        of = _nearest(x, centres)
        for c in range(len(centres)):
            mine = x[of == c]
            if len(mine):
                centres[c] = mine.mean(0)
    return centres


class Codebook:
    def __init__(self, sample: np.ndarray, rows: int, settings: Settings):
        self.settings = settings
        lists = int(np.clip(-(-rows // settings.list_rows), 1, settings.most_lists))
        self.coarse = kmeans(sample, lists)
        rest = sample - self.coarse[_nearest(sample, self.coarse)]
        self.cuts = np.linspace(0, sample.shape[1], min(settings.subspaces, sample.shape[1]) + 1).astype("i8")
        self.fine = [kmeans(rest[:, a:b], settings.codes) for a, b in zip(self.cuts, self.cuts[1:])]
        gap = self.coarse[:, None, :] - self.coarse[None, :, :]
        self.between = np.sqrt((gap**2).sum(2))

    def encode(self, x: np.ndarray):
        """Lists, codes, and the lengths of what the codes miss."""
        of = _nearest(x, self.coarse)
        rest = x - self.coarse[of]
        codes = np.stack([_nearest(rest[:, a:b], f) for f, a, b in zip(self.fine, self.cuts, self.cuts[1:])], 1).astype("u1")
        close = np.concatenate([f[codes[:, i]] for i, f in enumerate(self.fine)], 1)
        return of, codes, np.sqrt(((rest - close) ** 2).sum(1))

    def probes(self, x: np.ndarray, of: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists that can hold a vector within ``radius``: those whose dividing plane is
        within it, and the own one."""
        d2 = ((x[:, None, :] - self.coarse[None]) ** 2).sum(2) if len(x) * len(self.coarse) < 1 << 18 else (
            (x**2).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse**2).sum(1)[None])
        own = np.take_along_axis(d2, of[:, None], 1)
        reach = (d2 - own) <= 2 * radius * self.between[of] + 1e-9
        return [np.flatnonzero(r) for r in reach]

    def distances(self, rest: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of residuals to codes, summed from lookup tables."""
        out = np.zeros((len(rest), len(codes)))
        for i, (f, a, b) in enumerate(zip(self.fine, self.cuts, self.cuts[1:])):
            part = rest[:, a:b]
            table = ((part[:, None, :] - f[None]) ** 2).sum(2)
            out += table[:, codes[:, i]]
        return np.sqrt(out)


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v``, one row an id; ``v`` is null where the vector is of no use."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    fit = v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(False)) & F.coalesce(some, F.lit(False))
    rows = df.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.when(fit, v).alias("v")
    )
    idle = (F.col("label").isNull() | F.col("v").isNull()).alias("idle")
    first = rows.groupBy("vec_id").agg(F.min(F.struct(idle, "label", "v")).alias("row"))
    return first.select("vec_id", "row.label", "row.v")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i, j in zip(a.tolist(), b.tolist()):
        x, y = root(i), root(j)
        if x != y:
            parent[max(x, y)] = min(x, y)
            edges.append((i, j))
    return edges


def _unit(v: pd.Series) -> np.ndarray:
    x = np.stack(v.to_numpy()).astype("f8")
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    spark = df.sparkSession
    rows = checkpointed(usable_vectors(df, id_col, vector_col, label_col), "vectors")
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    # The length stands before the label, so it is part of every key from here on.
    dims = F.size("v")
    good = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull()).withColumn("label", F.concat(dims.cast("string"), F.lit(":"), "label"))
    counts = {r.dims: r.n for r in good.groupBy(dims.alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a length
    if not counts:
        return alone
    order, share = F.xxhash64("vec_id"), -(-settings.sample // len(counts))
    few = F.coalesce(*[F.when(dims == d, sampled(order, share, n)) for d, n in counts.items()])
    rank = F.row_number().over(Window.partitionBy("dims").orderBy("order", "vec_id"))
    sample = good.where(few).select(dims.alias("dims"), order.alias("order"), "vec_id", "v").withColumn("rank", rank)
    sample = sample.where(F.col("rank") <= share).orderBy("dims", "rank").select("dims", "v").toPandas()  # bounded by the setting
    books = {int(d): Codebook(_unit(f["v"]), counts[d], settings) for d, f in sample.groupby("dims")}
    book = spark.sparkContext.broadcast(books)  # bounded by the settings
    radius = float(np.sqrt(max(0.0, 2 - 2 * settings.threshold))) + 1e-9

    def index(frames):
        for f in (f for frame in frames for _, f in frame.groupby(frame["v"].map(len))):
            x = _unit(f["v"])
            mine = book.value[x.shape[1]]
            of, codes, miss = mine.encode(x)
            lists = mine.probes(x, of, radius)
            yield pd.DataFrame({
                "vec_id": f["vec_id"], "label": f["label"], "x": list(x), "home": of.astype("i4"), "probes": lists,
                "codes": [c.tobytes() for c in codes], "miss": miss,
            })

    indexed = checkpointed(
        good.mapInPandas(index, "vec_id long, label string, x array<double>, home int, probes array<int>, codes binary, miss double"), "pq-index"
    )
    tile = settings.tile
    sizes = indexed.groupBy("label", "home").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("tiles"))
    probing = indexed.select("vec_id", "label", "x", F.explode("probes").alias("home"))
    askers = probing.groupBy("label", "home").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("turns"))
    units = checkpointed(sizes.join(askers, ["label", "home"]), "pq-units")
    tile_of, turn_of = F.pmod(F.xxhash64("vec_id"), F.col("tiles")), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("turns"))
    held = indexed.join(units, ["label", "home"]).select(
        F.col("label").alias("l"), F.col("home").alias("h"), tile_of.cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("j"),
        F.col("vec_id").alias("id"), F.col("x").alias("y"), "codes", "miss",
    )
    asked = probing.join(units, ["label", "home"]).select(
        "label", "home", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"), turn_of.cast("int").alias("turn"), "vec_id", "x"
    )

    def compare(key, inside: pd.DataFrame, probe: pd.DataFrame) -> pd.DataFrame:
        if inside.empty or probe.empty:
            return pd.DataFrame({"u": [], "v": [], "n": []}).astype("int64")
        y, x = np.stack(inside["y"].to_numpy()), np.stack(probe["x"].to_numpy())
        codes = np.frombuffer(b"".join(inside["codes"]), "u1").reshape(len(inside), -1)
        mine = book.value[x.shape[1]]
        bound = mine.distances(x - mine.coarse[int(key[1])], codes) - inside["miss"].to_numpy()[None]
        a, b = np.nonzero(bound <= radius)
        cuts = range(0, len(a), 1 << 16)  # one routine for all pairs, a bounded number at a time
        links = [np.einsum("ij,ij->i", x[a[i : i + (1 << 16)]], y[b[i : i + (1 << 16)]]) >= settings.threshold for i in cuts]
        links = np.concatenate(links) if links else np.zeros(0, bool)
        ids, others = probe["vec_id"].to_numpy(), inside["id"].to_numpy()
        a, b = a[links], b[links]
        differ = ids[a] != others[b]
        a, b = a[differ], b[differ]
        n = np.bincount(a, minlength=len(ids))
        nodes, at = np.unique(np.concatenate((ids, others)), return_inverse=True)
        forest = _forest(at[: len(ids)][a], at[len(ids) :][b], len(nodes))
        has = np.flatnonzero(n)
        rows = [(int(ids[i]), int(ids[i]), int(n[i])) for i in has] + [(int(nodes[i]), int(nodes[j]), 0) for i, j in forest]
        return pd.DataFrame(rows, columns=["u", "v", "n"]).astype("int64")

    found = held.groupBy("l", "h", "i", "j").cogroup(asked.groupBy("label", "home", "tile", "turn")).applyInPandas(compare, "u long, v long, n long")
    found = checkpointed(found, "pq-links")
    counts = found.where("n > 0").groupBy(F.col("u").alias("vec_id")).agg(F.sum("n").alias("n_links"))
    components = connected_components(found.where("n = 0").select("u", "v")).withColumnRenamed("node", "vec_id")
    out = rows.select("vec_id").join(counts, "vec_id", "left").join(components, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
