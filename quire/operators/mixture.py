"""Weighted corpus mixture: token budgets, val/train split, interleaving, shards.

The sequential greedy mixer ("always take the next document of the least-progressed
source") is a k-way merge by a key every document knows in advance:
``progress = tokens of earlier documents of the same source / source target``.
Within a source progress strictly increases, so the merged stream is simply the
global order by ``(progress, tie-break)``. Everything below is therefore a few
prefix sums and filters; no sequential state and no single-task step.

Columns of the *plan* (one row per emitted document):
``split, source, doc_id, n_tokens, cum, n_written, progress, tiebreak, seq, stream_offset``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.config import DataMixConfig, shares, val_shard_size
from quire.functions.hashing import hex_bucket, order_key
from quire.plans.materialize import checkpointed
from quire.plans.prefix import exclusive_prefix_sums

SPLITS = ("val", "train")


# ---------------------------------------------------------------- targets


def source_table(spark: SparkSession, mix: DataMixConfig) -> DataFrame:
    """One row per configured source: ``source, source_index, weight, share``.

    Bounded by the number of configured sources, so it is always safe to broadcast.
    """
    part = shares(mix)
    rows = [(s.name, i, float(s.weight), part[s.name]) for i, s in enumerate(mix.sources)]
    return spark.createDataFrame(rows, "source string, source_index int, weight double, share double")


def allocate_targets(sources: DataFrame, total: Column | int, out: str = "target") -> DataFrame:
    """Split ``total`` tokens by ``share``: floor of each share, then the leftover one
    token at a time by largest fractional part (ties: larger name first), cycling when
    the leftover exceeds the number of sources. ``sources`` is the small source table."""
    total_c = (F.lit(int(total)) if isinstance(total, int) else total).cast("long")
    everything = Window.partitionBy()  # small table: number of sources rows
    raw = total_c.cast("double") * F.col("share")
    staged = (
        sources.withColumn("__raw", raw)
        .withColumn("__base", F.floor("__raw").cast("long"))
        .withColumn("__frac", F.col("__raw") - F.floor("__raw"))
        .withColumn("__n", F.count(F.lit(1)).over(everything))
        .withColumn("__rem", F.greatest(total_c - F.sum("__base").over(everything), F.lit(0)))
        .withColumn("__rank", F.row_number().over(Window.orderBy(F.desc("__frac"), F.desc("source"))) - 1)
    )
    target = (
        F.col("__base")
        + F.floor(F.col("__rem") / F.col("__n")).cast("long")
        + F.when(F.col("__rank") < F.col("__rem") % F.col("__n"), 1).otherwise(0)
    )
    return staged.withColumn(out, target).drop("__raw", "__base", "__frac", "__n", "__rem", "__rank")


def available_tokens(docs: DataFrame) -> DataFrame:
    """Per source: documents and tokens on offer (``source, available_docs, available_tokens``)."""
    return docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("available_docs"), F.sum("n_tokens").alias("available_tokens")
    )


def mixture_targets(
    sources: DataFrame,
    train_tokens: Column | int,
    val_tokens: Column | int,
) -> DataFrame:
    """``source, weight, share, train_target, val_target``."""
    t = allocate_targets(sources, train_tokens, "train_target")
    return allocate_targets(t, val_tokens, "val_target")


def fraction_budget(docs: DataFrame, sources: DataFrame, train_fraction: float, val_fraction: float) -> DataFrame:
    """Targets sized from the data: ``floor(fraction x tokens on offer)`` for each split.

    All arithmetic stays in DataFrames (a per-source aggregate plus a window over the
    small source table); nothing goes through the driver.
    """
    avail = available_tokens(docs)
    with_avail = sources.join(avail, "source", "left").fillna(0, ["available_docs", "available_tokens"])
    everything = Window.partitionBy()
    tot = F.sum("available_tokens").over(everything)
    staged = with_avail.withColumn("__train_total", F.floor(tot * F.lit(train_fraction)).cast("long")).withColumn(
        "__val_total", F.floor(tot * F.lit(val_fraction)).cast("long")
    )
    t = allocate_targets(staged, F.col("__train_total"), "train_target")
    t = allocate_targets(t, F.col("__val_total"), "val_target")
    return t.drop("__train_total", "__val_total")


# ---------------------------------------------------------------- plan


def source_order(docs: DataFrame, seed: int, digits: int = 3) -> DataFrame:
    """Seeded shuffle of each source: ``skey`` (md5 order key) and ``sbucket``."""
    key = order_key(seed, "source", "doc_id")
    return docs.withColumn("skey", key).withColumn("sbucket", hex_bucket(F.col("skey"), digits))


def budget_buckets(docs: DataFrame, targets: DataFrame, seed: int, digits: int = 3, most_rows: int = 1 << 22) -> tuple[int, DataFrame]:
    """The order buckets that can hold a document of a source's budget, found from bucket
    totals and written once: ``source, sbucket``, ``__first`` and ``__after`` (tokens of the
    source before and up to the end of the bucket), both targets and ``__val_end`` (the end
    of the bucket in which val fills, so the last val document ends by there). Buckets get
    more digits until none has over ``most_rows`` documents. Returns the digits, too."""
    while True:
        keyed = source_order(docs, seed, digits)
        sums = keyed.groupBy("source", "sbucket").agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("__tokens"), F.count(F.lit(1)).alias("__rows"))
        totals = checkpointed(sums, "budget-totals")
        fullest = totals.agg(F.max("__rows")).first()[0] or 0
        if fullest <= most_rows or digits >= 7:
            break
        digits = min(7, digits + 1 + int(math.log(fullest / most_rows, 16)))
    source = Window.partitionBy("source")
    before = F.sum("__tokens").over(source.orderBy("sbucket").rowsBetween(Window.unboundedPreceding, -1))
    # bounded: one row per configured source
    small = F.broadcast(targets.select("source", "train_target", "val_target"))
    spans = totals.withColumn("__first", F.coalesce(before, F.lit(0))).withColumn("__after", F.col("__first") + F.col("__tokens")).join(small, "source")
    val_end = F.max(F.when(F.col("__first") < F.col("val_target"), F.col("__after"))).over(source)
    spans = spans.withColumn("__val_end", F.coalesce(val_end, F.lit(0)))
    train = (F.col("train_target") > 0) & (F.col("__first") < F.col("__val_end") + F.col("train_target"))
    return digits, checkpointed(spans.where((F.col("__first") < F.col("val_target")) | train).drop("__tokens", "__rows"), "budget-buckets")


def _running(rows: DataFrame) -> DataFrame:
    """``src_cum``: tokens of earlier documents of the source, summed inside a bucket."""
    within = Window.partitionBy("source", "sbucket").orderBy("skey", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("src_cum", F.col("__first") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).drop("__first", "__after", "__val_end")


def _split(ranked: DataFrame) -> DataFrame:
    """Rows with ``src_cum`` and targets → those selected, with ``split, cum, target, n_written``."""
    is_val = (F.col("val_target") > 0) & (F.col("src_cum") < F.col("val_target"))
    consumed = ranked.where(is_val).groupBy("source").agg(F.max(F.col("src_cum") + F.col("n_tokens")).alias("val_consumed"))
    joined = ranked.join(F.broadcast(consumed), "source", "left").fillna(0, ["val_consumed"])
    train_cum = F.col("src_cum") - F.col("val_consumed")
    is_train = (F.col("train_target") > 0) & (train_cum >= 0) & (train_cum < F.col("train_target"))
    return (
        joined.withColumn("split", F.when(is_val, F.lit("val")).when(is_train, F.lit("train")))
        .where(F.col("split").isNotNull())
        .withColumn("cum", F.when(is_val, F.col("src_cum")).otherwise(train_cum))
        .withColumn("target", F.when(is_val, F.col("val_target")).otherwise(F.col("train_target")))
        .withColumn("n_written", F.least(F.col("n_tokens"), F.col("target") - F.col("cum")))
        .drop("val_consumed")
    )


def take_budget(docs: DataFrame, targets: DataFrame, seed: int, digits: int = 3, most_rows: int = 1 << 22) -> DataFrame:
    """Per source, in seeded order: exclusive running token sum ``cum``; val takes
    documents while ``cum < val_target``; train restarts the sum after the last val
    document and takes documents while the restarted sum is below ``train_target``.
    The last document of each split is cut to the remaining budget (its tail is
    dropped, so splits stay document-disjoint). Adds ``split, cum, n_written`` and
    keeps only selected documents.

    Reads ``docs`` twice: for bucket totals, and for the documents of the buckets the budget
    reaches; only these are shuffled and sorted, bucket by bucket, and written once."""
    digits, buckets = budget_buckets(docs, targets, seed, digits, most_rows)
    rows = source_order(docs, seed, digits).join(buckets, ["source", "sbucket"])
    return _split(checkpointed(_running(rows), "budget-rows"))


def select_budget(docs: DataFrame, targets: DataFrame, seed: int, digits: int = 3, most_rows: int = 1 << 22) -> DataFrame:
    """The documents of ``take_budget`` with ``split, n_written`` but without running sums:
    buckets that lie wholly inside a split are taken unsorted by a join with the bucket
    table, and only those in which a split can end (a few per source) are sorted."""
    digits, buckets = budget_buckets(docs, targets, seed, digits, most_rows)
    in_val = F.col("__after") < F.col("val_target")
    in_train = (F.col("__first") >= F.col("__val_end")) & (F.col("__after") < F.col("val_target") + F.col("train_target"))
    rows = source_order(docs, seed, digits).join(buckets.withColumn("split", F.when(in_val, F.lit("val")).when(in_train, F.lit("train"))), ["source", "sbucket"])
    columns = [*docs.columns, "split", "n_written"]
    edge = checkpointed(_running(rows.where(F.col("split").isNull()).drop("split")), "budget-edge")
    whole = rows.where(F.col("split").isNotNull()).withColumn("n_written", F.col("n_tokens"))
    return whole.select(columns).unionByName(_split(edge).select(columns))


def interleave(selected: DataFrame, seed: int, buckets: int = 4096) -> DataFrame:
    """Global stream order per split: ``progress = cum / target``, ties by a seeded
    hash. Adds ``progress, tiebreak, seq`` (1-based position) and ``stream_offset`` (first
    token of the document in the split's stream)."""
    staged = (
        selected.withColumn("progress", F.col("cum").cast("double") / F.col("target").cast("double"))
        .withColumn("tiebreak", order_key(seed, "split", "source", "doc_id"))
        .withColumn("pbucket", F.least(F.floor(F.col("progress") * F.lit(buckets)).cast("int"), F.lit(buckets - 1)))
    )
    out = exclusive_prefix_sums(
        staged, ["split"], "pbucket", ["progress", "tiebreak"], {"stream_offset": "n_written", "seq": F.lit(1).cast("long")}
    )
    return out.withColumn("seq", F.col("seq") + 1).drop("pbucket")


def plan_mixture(docs: DataFrame, targets: DataFrame, seed: int = 42, digits: int = 3, buckets: int = 4096) -> DataFrame:
    """``docs(source, doc_id, n_tokens, …)`` → the emitted-document plan. ``docs`` is read
    twice: pass it checkpointed (``quire.plans.materialize``) where it is costly."""
    return interleave(take_budget(docs, targets, seed, digits), seed, buckets)


def shard_sizes(mix: DataMixConfig) -> dict[str, int]:
    return {"train": mix.shard_size_tokens, "val": val_shard_size(mix)}


def shard_size_col(sizes: dict[str, int]) -> Column:
    return F.when(F.col("split") == "val", F.lit(sizes["val"])).otherwise(F.lit(sizes["train"])).cast("long")


def assign_shards(plan: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """Cut each split's stream every ``size`` tokens. A document spanning a boundary
    becomes several pieces: ``shard, shard_pos`` (first token in the shard),
    ``doc_start`` (first token in the document) and ``length``."""
    size = shard_size_col(sizes)
    first = F.floor(F.col("stream_offset") / size).cast("long")
    last = F.floor((F.col("stream_offset") + F.col("n_written") - 1) / size).cast("long")
    exploded = plan.withColumn("__size", size).withColumn("shard", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("stream_offset"), F.col("shard") * F.col("__size"))
    end = F.least(F.col("stream_offset") + F.col("n_written"), (F.col("shard") + 1) * F.col("__size"))
    return (
        exploded.withColumn("__start", start)
        .withColumn("length", end - F.col("__start"))
        .withColumn("shard_pos", F.col("__start") - F.col("shard") * F.col("__size"))
        .withColumn("doc_start", F.col("__start") - F.col("stream_offset"))
        .drop("__size", "__start")
    )


def shard_manifest(pieces: DataFrame) -> DataFrame:
    """``split, shard, path, num_tokens, dtype`` — one row per shard file."""
    return (
        pieces.groupBy("split", "shard")
        .agg(F.sum("length").alias("num_tokens"))
        .withColumn("path", F.format_string("%s_%05d.bin", F.col("split"), F.col("shard").cast("int")))
        .withColumn("dtype", F.lit("uint16"))
        .select("split", "shard", "path", "num_tokens", "dtype")
    )


# ---------------------------------------------------------------- reports


def mix_report(plan: DataFrame, targets: DataFrame) -> DataFrame:
    """Per configured source (unused sources stay, with zeros): targets, tokens
    written per split and documents used."""
    per = plan.groupBy("source").agg(
        F.sum(F.when(F.col("split") == "train", F.col("n_written")).otherwise(0)).alias("train_tokens_written"),
        F.sum(F.when(F.col("split") == "val", F.col("n_written")).otherwise(0)).alias("val_tokens_written"),
        F.count(F.lit(1)).alias("documents_used"),
    )
    return (
        targets.select("source", F.col("train_target").alias("train_target_tokens"), F.col("val_target").alias("val_target_tokens"))
        .join(per, "source", "left")
        .fillna(0, ["train_tokens_written", "val_tokens_written", "documents_used"])
    )


def shortage_check(report: DataFrame) -> DataFrame:
    """Adds ``train_short``/``val_short``: tokens missing to reach each target."""
    return report.withColumn(
        "train_short", F.col("train_target_tokens") - F.col("train_tokens_written")
    ).withColumn("val_short", F.col("val_target_tokens") - F.col("val_tokens_written"))


def enforce_shortage_policy(report: DataFrame, policy: str = "error") -> None:
    """``error`` (default, like the original job): fail when any source ran out before
    its target. ``truncate``: accept the shortfall. Collects one row per source."""
    if policy == "truncate":
        return
    if policy != "error":
        raise ValueError(f"unknown shortage policy {policy!r}")
    short = shortage_check(report).where("train_short > 0 OR val_short > 0").select("source", "train_short", "val_short")
    rows = short.limit(1000).collect()
    if rows:
        detail = ", ".join(f"{r.source}: train -{r.train_short}, val -{r.val_short}" for r in rows)
        raise RuntimeError(f"not enough data to fill the mixture targets ({detail})")


def mix_drift(plan: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual share of each source in each split vs the configured share."""
    written = plan.groupBy("split", "source").agg(F.sum("n_written").alias("tokens"))
    per_split = Window.partitionBy("split")
    return (
        written.withColumn("actual_share", F.col("tokens") / F.sum("tokens").over(per_split))
        .join(F.broadcast(targets.select("source", "share")), "source", "left")
        .withColumn("drift", F.col("actual_share") - F.col("share"))
    )


def token_stats(plan: DataFrame) -> DataFrame:
    """Documents and tokens per split and source."""
    return plan.groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_written").alias("tokens"),
        F.min("n_written").alias("min_tokens"),
        F.max("n_written").alias("max_tokens"),
    )


# ---------------------------------------------------------------- budget prefilter


def budget_prefilter(light: DataFrame, targets: DataFrame, seed: int, est_col: str = "est", margin: float = 1.25,
                     digits: int = 3) -> DataFrame:
    """Keep, per source, the leading hash buckets (in seeded order) whose *estimated*
    tokens reach ``margin x (val_target + train_target)``; later buckets cannot hold a
    selected document unless the estimate was too low, which ``plan_with_prefilter``
    checks. ``light`` is ``(source, doc_id, est)`` — cheap columns only."""
    ordered = source_order(light, seed, digits)
    per_bucket = ordered.groupBy("source", "sbucket").agg(F.sum(est_col).alias("__est"))
    w = Window.partitionBy("source").orderBy("sbucket").rowsBetween(Window.unboundedPreceding, -1)
    need = targets.select("source", ((F.col("val_target") + F.col("train_target")).cast("double") * F.lit(margin)).alias("__need"))
    # per_bucket is bounded by sources x 16**digits rows.
    kept_b = (
        per_bucket.withColumn("__before", F.coalesce(F.sum("__est").over(w), F.lit(0)))
        .join(F.broadcast(need), "source")
        .where(F.col("__before") < F.col("__need"))
        .select("source", "sbucket")
    )
    return ordered.join(kept_b, ["source", "sbucket"], "left_semi").drop("skey", "sbucket")


def plan_with_prefilter(light: DataFrame, targets: DataFrame, tokenize, seed: int = 42, est_col: str = "est",
                        margin: float = 1.25, widenings: int = 4, digits: int = 3, buckets: int = 4096) -> DataFrame:
    """``plan_mixture`` that tokenizes only a verified prefix of each source.

    ``tokenize(kept_light) -> docs(source, doc_id, n_tokens, …)`` is the expensive step.
    The plan over a per-source prefix equals the plan over everything when the prefix
    is the whole source or its real tokens reach ``val_consumed + train_target``; this
    is checked on a one-row-per-source table. The margin doubles until it holds; after
    ``widenings`` the whole source is tokenized, which is always right. The tokenized
    prefix is written once to the checkpoint folder."""
    n_all = light.groupBy("source").agg(F.count(F.lit(1)).alias("__n_all"))
    for k in range(widenings + 1):
        kept = budget_prefilter(light, targets, seed, est_col, margin * 2.0**k, digits) if k < widenings else light
        docs = checkpointed(tokenize(kept), "prefix")
        plan = plan_mixture(docs, targets, seed, digits, buckets)
        have = docs.groupBy("source").agg(F.sum("n_tokens").alias("__have"), F.count(F.lit(1)).alias("__n_kept"))
        val_used = plan.where(F.col("split") == "val").groupBy("source").agg(F.max(F.col("cum") + F.col("n_tokens")).alias("__vc"))
        check = (
            targets.select("source", "train_target", "val_target")
            .join(n_all, "source", "left").join(have, "source", "left").join(val_used, "source", "left")
            .fillna(0, ["__n_all", "__have", "__n_kept", "__vc"])
            .where((F.col("__n_kept") < F.col("__n_all")) & (F.col("__have") < F.col("__vc") + F.col("train_target")))
        )
        if k == widenings or check.isEmpty():
            return plan
    raise AssertionError("unreachable")
