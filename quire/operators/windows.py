"""Training windows over the sharded token stream.

A window is ``seq_len + 1`` consecutive tokens of one shard; inputs are the first
``seq_len`` and labels the last ``seq_len`` (shifted by one). Windows are planned on
the shard manifest (one row per shard) and filled from document *pieces* with array
slices — never one row per token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.hashing import order_key, unit_interval
from quire.plans.prefix import exclusive_prefix_sums


SHARDS_PER_BUCKET = 1024


def _bucketed(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("__bucket", F.floor(F.col("shard") / F.lit(SHARDS_PER_BUCKET)).cast("long"))


def sequential_window_counts(manifest: DataFrame, seq_len: int) -> DataFrame:
    """Per shard: number of sequential windows and the global index of its first one (a
    bucketed prefix sum, so no task holds the whole manifest)."""
    L = seq_len
    max_start = F.col("num_tokens") - F.lit(L + 1)
    counts = manifest.withColumn("n_windows", F.when(max_start > 0, F.floor((max_start - 1) / F.lit(L)) + 1).otherwise(0))
    return exclusive_prefix_sums(_bucketed(counts), ["split"], "__bucket", ["shard"], {"first_idx": "n_windows"}).drop("__bucket")


def sequential_windows(manifest: DataFrame, seq_len: int, max_windows: int | None = None) -> DataFrame:
    """Per shard, starts ``0, L, 2L, …`` below ``num_tokens - L - 1``; shards too short
    for one window are skipped; windows are numbered across shards in shard order and
    stop after ``max_windows``. Output: ``split, shard, start, window_idx``."""
    L = seq_len
    counts = sequential_window_counts(manifest, L)
    # A shard can hold ~10^5-10^6 windows: spread shards over tasks before generating them.
    counts = counts.repartition("split", "shard")
    w = counts.where(F.col("n_windows") > 0).select(
        "split", "shard", "num_tokens", "first_idx", F.explode(F.sequence(F.lit(0), F.col("n_windows") - 1)).alias("k")
    )
    out = w.select(
        "split", "shard", "num_tokens", (F.col("k") * F.lit(L)).cast("long").alias("start"),
        (F.col("first_idx") + F.col("k")).cast("long").alias("window_idx"),
    )
    if max_windows is not None:
        out = out.where(F.col("window_idx") < F.lit(max_windows))
    return out


def random_windows(spark: SparkSession, manifest: DataFrame, n: int, seq_len: int, seed: int, split: str = "train", buckets: int = 65_536) -> DataFrame:
    """``n`` windows drawn with replacement: shard with probability proportional to
    its capacity ``num_tokens - L - 1`` (shards without capacity skipped), start uniform
    in ``[0, capacity)``. Drawing a global position uniformly over the concatenated
    capacities is the same distribution; draw ``d`` uses ``md5(seed:d)``.

    The manifest may have any number of rows: capacities are accumulated bucket-wise, their
    total is a scalar subquery, and the shard lookup is an equi-join on a position
    bucket (a fixed share of the total), then a range check. Without any capacity the
    query fails when it runs."""
    L = seq_len
    cap = F.greatest(F.col("num_tokens") - F.lit(L + 1), F.lit(0))
    shards = _bucketed(manifest.where(F.col("split") == split).withColumn("cap", cap).where(F.col("cap") > 0))
    shards = exclusive_prefix_sums(shards, ["split"], "__bucket", ["shard"], {"cum": "cap"})
    total = shards.agg(F.coalesce(F.sum("cap"), F.lit(0))).scalar()
    size = F.greatest(F.ceil(total / F.lit(buckets)), F.lit(1))
    ends = F.sequence(F.floor(F.col("cum") / F.col("size")), F.floor((F.col("cum") + F.col("cap") - 1) / F.col("size")))
    shard_b = shards.withColumn("size", size).select("shard", "cap", "cum", F.explode(ends).alias("b"))
    u = unit_interval(order_key(seed, F.col("draw")))
    draws = spark.range(n).withColumnRenamed("id", "draw").withColumn("total", total).withColumn("size", size)
    draws = draws.withColumn("g", F.floor(u * F.col("total").cast("double")).cast("long")).select("draw", "g", F.floor(F.col("g") / F.col("size")).alias("b"))
    # Only where there is no room at all a draw finds no shard.
    hit = draws.join(shard_b, "b", "left").where(F.col("shard").isNull() | ((F.col("g") >= F.col("cum")) & (F.col("g") < F.col("cum") + F.col("cap"))))
    shard = F.coalesce("shard", F.raise_error(F.lit("no shard has room for a window of this length")).cast("long"))
    return hit.select(F.lit(split).alias("split"), "draw", shard.alias("shard"), (F.col("g") - F.col("cum")).alias("start"))


def window_tokens(windows_or_manifest: DataFrame, pieces: DataFrame, seq_len: int, tokens_col: str = "tokens",
                  max_windows: int | None = None) -> DataFrame:
    """Fill sequential windows with their ``seq_len + 1`` tokens from document pieces
    ``(split, shard, shard_pos, length, tokens)`` — ``tokens`` being the piece's own
    tokens. ``windows_or_manifest`` is the shard manifest (``split, shard,
    num_tokens``; one row per shard).

    Each piece is cut into its overlaps with the windows it touches *before* the
    shuffle (a token reaches at most two windows), window numbers come from the
    per-shard table, and the group per window is bounded by
    ``seq_len + 1`` tokens. Output: ``split, shard, start, window_idx, tokens``."""
    L = seq_len
    per_shard = sequential_window_counts(windows_or_manifest, L).select("split", "shard", "first_idx", "n_windows")
    a, ln = F.col("shard_pos"), F.col("length")
    k_min = F.greatest(F.floor((a - 1) / F.lit(L)), F.lit(0))
    k_max = F.floor((a + ln - 1) / F.lit(L))
    p = pieces.select("split", "shard", "shard_pos", "length", F.col(tokens_col).alias("__t"),
                      F.explode(F.sequence(k_min, k_max)).alias("k"))
    start = F.col("k") * F.lit(L)
    lo = F.greatest(F.col("shard_pos"), start)
    hi = F.least(F.col("shard_pos") + F.col("length"), start + F.lit(L + 1))
    cut = p.where(hi > lo).select(
        "split", "shard", "k", F.struct(lo.alias("at"), F.slice("__t", lo - F.col("shard_pos") + 1, hi - lo).alias("ids")).alias("part")
    )
    cut = cut.join(per_shard, ["split", "shard"]).where(F.col("k") < F.col("n_windows"))
    cut = cut.withColumn("window_idx", (F.col("first_idx") + F.col("k")).cast("long"))
    if max_windows is not None:
        cut = cut.where(F.col("window_idx") < F.lit(max_windows))
    g = cut.groupBy("split", "shard", "k", "window_idx").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return g.select(
        "split", "shard", (F.col("k") * F.lit(L)).cast("long").alias("start"), "window_idx",
        F.flatten(F.transform("parts", lambda x: x["ids"])).alias("tokens"),
    )


def shift_labels(tokens: str | Column, seq_len: int) -> tuple[Column, Column, Column]:
    """``(input_ids, labels, attention_mask)`` of a window of ``seq_len + 1`` tokens."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.slice(t, 1, seq_len), F.slice(t, 2, seq_len), F.array_repeat(F.lit(1), seq_len)


def window_nll(windows: DataFrame, logprobs: list[float], seq_len: int, batch_size: int, labels: str = "labels") -> DataFrame:
    """Per window: summed negative log-likelihood of its labels under a per-token
    log-prob table (a literal array — bounded by the vocabulary) and its batch."""
    table = F.array(*[F.lit(float(x)) for x in logprobs])
    nll = F.aggregate(F.transform(F.col(labels), lambda t: -F.element_at(table, t + 1)), F.lit(0.0), lambda acc, x: acc + x)
    return windows.withColumn("nll_sum", nll).withColumn("n_labels", F.size(labels)).withColumn(
        "batch", F.floor(F.col("window_idx") / F.lit(batch_size)).cast("long")
    )


def batch_losses(window_nll_df: DataFrame, keys=("split",)) -> DataFrame:
    """Mean token loss of every batch (the loss a model reports for that batch)."""
    return window_nll_df.groupBy(*keys, "batch").agg((F.sum("nll_sum") / F.sum("n_labels")).alias("batch_loss"))
