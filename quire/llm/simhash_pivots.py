"""SimHash near-duplicates through a pivot distance table.

Every distinct 64-bit fingerprint gets a row of Hamming distances to ``PIVOTS``
reference fingerprints. By the triangle inequality two fingerprints within ``max_bits``
differ by at most ``max_bits`` in *every* coordinate of that table, so a pair whose
largest coordinate difference is higher is discarded without a look at its bits, and
only survivors are verified.

Pairs meet without a cross join and without loss: the 64 bits fall in ``max_bits + 3``
blocks, at most ``max_bits`` of which can hold a difference, so two linked fingerprints
agree on some three whole blocks; each fingerprint is dealt to one group for every
choice of three blocks (about 32 equal bits). A group larger than a tile is cut into
tiles, every pair of which is one unit of work, so a hot group spreads over tasks.
Inside a unit, pairs already connected are skipped and only the edges of a spanning
forest leave the task: a group of n near copies yields fewer than n rows.

Defined results: a null or empty text, and one without words, has fingerprint zero and
links like any other; fewer words than a shingle are one shingle; a null ``doc_id`` is
never the smallest id of a component that has another; repeated rows link to each
other through their equal fingerprint; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.batches import documents, lower_words, pieces_of, raw_texts, tasks_for
from quire.llm.components import connected_components
from quire.plans.materialize import checkpointed

SEED = 42
PIVOTS = 16
TILE = 2048
_BLOCK = 255  # rows whose one-bit counts fit a byte


def pivots(n: int = PIVOTS) -> list[int]:
    """``n`` reference fingerprints, spread evenly by a hash of their number."""
    return [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(n)]


def simhash(words: list[bytes], shingle: int) -> int:
    """Unsigned 64-bit fingerprint: bit set where over half the shingle hashes have it."""
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[: len(words) - size]))
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist())], "<u8")
    bits = np.unpackbits(hashes.view("u1"), bitorder="little").view("<u8").reshape(-1, 8)
    lanes = np.add.reduceat(bits, np.arange(0, len(bits), _BLOCK), axis=0).view("u1").reshape(-1, 64)
    ones = lanes.sum(0, dtype="i8")
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, text_key, fp`` (a hash of the text; the fingerprint's 64 bits as a signed long)."""

    def run(batches):
        for big in batches:
            for b in pieces_of(big):
                fps = np.array([simhash(lower_words(t), shingle) for t in raw_texts(b.column(1))], "u8")
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view("i8"))], names=["doc_id", "text_key", "fp"])

    keyed = documents(df, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(run, "doc_id long, text_key long, fp long")


def block_masks(max_bits: int, agree: int = 3) -> list[int]:
    """Masks of the bits that two fingerprints within ``max_bits`` share under some
    choice of ``agree`` blocks out of ``max_bits + agree``."""
    n = max_bits + agree
    cut = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cut, cut[1:])]
    return [sum(blocks[i] for i in c) for c in combinations(range(n), agree)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _pivot_table(fp) -> list:
    """The table's row packed eight distances to a long."""
    out = []
    for i in range(0, PIVOTS, 8):
        word = F.lit(0).cast("long")
        for j, p in enumerate(pivots()[i : i + 8]):
            word = word.bitwiseOR(F.shiftleft(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long"), 8 * j))
        out.append(word.alias(f"pivots{i // 8}"))
    return out


def _forest(unit: np.ndarray, fp: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over the links inside each run of equal ``unit``."""
    n = len(fp)
    parent = np.arange(n)
    edges: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    at, step = np.arange(n - 1), 1
    while True:
        at = at[at + step < n]
        at = at[unit[at] == unit[at + step]]
        if not len(at):
            return edges
        a = at[parent[at] != parent[at + step]]
        for j in range(table.shape[1]):
            if not len(a):
                break
            far = np.abs(table[a, j] - table[a + step, j])
            a = a[far <= max_bits]
        if len(a):
            a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= max_bits]
        joined = False
        for i in a.tolist():
            x, y = root(i), root(i + step)
            if x != y:
                parent[max(x, y)] = min(x, y)
                edges.append((i, i + step))
                joined = True
        if joined:  # every node points at its root again
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
        step += 1


def links(fps: DataFrame, max_bits: int = 3, tile: int = TILE) -> DataFrame:
    """``fps(fp)`` of distinct fingerprints → edges ``(u, v)`` that connect exactly the
    fingerprints connected by links of at most ``max_bits``."""
    n = tasks_for(fps.sparkSession)
    masks = [_signed(m) for m in block_masks(max_bits)]
    dealt = fps.select(
        "fp", F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])).alias("k")
    ).select("k.choice", "k.bits", "fp")
    met = dealt.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    near = dealt.join(met, ["choice", "bits"]).withColumn("tiles", F.ceil(F.col("size") / F.lit(tile)).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    units = (
        near.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("choice", "bits", F.least("own", "other").alias("t0"), F.greatest("own", "other").alias("t1"), "fp", *_pivot_table(F.col("fp")))
        .repartition(n, "choice", "bits", "t0", "t1")
        .sortWithinPartitions("choice", "bits", "t0", "t1", "fp")
    )

    def flush(cols: list[np.ndarray]) -> pa.RecordBatch:
        changed = np.zeros(len(cols[0]), bool)
        for c in cols[:4]:
            changed[1:] |= c[1:] != c[:-1]
        fp = cols[4].view("u8")
        table = np.stack(cols[5:], axis=1).view("u1").astype("i2")
        found = _forest(np.cumsum(changed), fp, table, max_bits)
        pairs = np.array(found, "i8").reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(cols[4][pairs[:, 0]]), pa.array(cols[4][pairs[:, 1]])], names=["u", "v"])

    def run(batches, enough: int = 1 << 17):
        held: list[np.ndarray] | None = None
        for b in batches:
            cols = [np.ascontiguousarray(b.column(i).to_numpy(zero_copy_only=False)) for i in range(b.num_columns)]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if len(held[0]) >= enough:  # up to where the last unit begins
                last = np.zeros(len(held[0]), bool)
                for c in held[:4]:
                    last[1:] |= c[1:] != c[:-1]
                cut = int(np.flatnonzero(last)[-1]) if last.any() else 0
                if cut:
                    yield flush([c[:cut] for c in held])
                    held = [c[cut:] for c in held]
        if held is not None and len(held[0]):
            yield flush(held)

    return units.mapInArrow(run, "u long, v long")


def _components(docs: DataFrame, max_bits: int) -> DataFrame:
    """``fp, component`` (a fingerprint that names the component), ``component_id``."""
    distinct = docs.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    components = connected_components(links(docs.select("fp").distinct(), max_bits))
    whole = distinct.join(components, distinct.fp == components.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = whole.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return checkpointed(whole.join(smallest, "component").select("fp", "component", "component_id"), "fp-components")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest ``doc_id`` reachable over links."""
    docs = checkpointed(fingerprints(df, id_col, text_col, shingle), "fp")
    named = _components(docs, max_bits)
    return docs.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each component (all columns kept): that of the smallest id, of rows that
    repeat this id the one with the smallest text hash, of rows that repeat the text as well
    any one. Rows that repeat an id with a text of another component are judged apart. A null
    id stays only where its component has no other."""
    docs = checkpointed(fingerprints(df, id_col, text_col, shingle), "fp")
    copies = docs.join(_components(docs, max_bits), "fp").groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "n")).alias("first")
    kept = copies.groupBy("component").agg(first).select(F.col("first.doc_id").alias("__id"), F.col("first.text_key").alias("__key"), F.col("first.n").alias("__n"))
    kept = checkpointed(kept, "simhash-kept")
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__key"))
    once = df.join(kept.where("__n = 1"), same, "left_semi")
    again = kept.where("__n > 1")
    if again.isEmpty():
        return once
    return once.unionByName(df.join(again, same).dropDuplicates(["__id", "__key"]).select(df.columns))
