"""Run analytics over metric logs (``quire.sources.metrics`` schema).

Per-run ordered lookups (previous train row, last checkpoint written to a path) use
the bucketed as-of primitive, so one long run never lands in a single task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.plans.asof import epoch_micros, last_before, last_before_many, time_bucket
from quire.plans.materialize import checkpointed

BUCKET_SECONDS = 6 * 3600  # as-of buckets: 6 hours of log time


def select_events(log: DataFrame, *events: str) -> DataFrame:
    return log.where(F.col("event").isin(*events))


def run_index(log: DataFrame) -> DataFrame:
    return select_events(log, "run_started").select(
        "run_id", F.col("ts").alias("started_at"), "log_path", "metrics_path", "model_config", "train_config", "args"
    )


def runtime_summary(log: DataFrame) -> DataFrame:
    """Both variants: shard-based (pretraining) and example-based (fine-tuning)."""
    return select_events(log, "runtime_summary").select(
        "run_id", "ts", "device", "precision", "compile_model", "parameters", "seq_len", "micro_batch_size",
        "grad_accum_steps", "tokens_per_step", "num_train_shards", "train_dir", "val_dir", "dataset_path",
        "train_examples", "val_examples",
        F.when(F.col("num_train_shards").isNotNull(), F.lit("pretrain")).when(F.col("dataset_path").isNotNull(), F.lit("sft")).alias("kind"),
    )


def train_curve(log: DataFrame) -> DataFrame:
    return select_events(log, "train").select(
        "run_id", "step", "ts", "loss", "lr", "tok_per_sec", "grad_norm", "tokens_seen", "elapsed_sec",
        "allocated_gb", "reserved_gb", "max_allocated_gb", "max_reserved_gb",
    )


def eval_curve(log: DataFrame) -> DataFrame:
    """Eval rows plus each run's best (lowest val loss, earliest on ties) step."""
    ev = select_events(log, "eval").select("run_id", "step", "ts", "val_loss", "perplexity", "eval_batches")
    best = ev.groupBy("run_id").agg(
        F.min_by("step", F.struct("val_loss", "step")).alias("best_step"), F.min("val_loss").alias("best_val_loss")
    )
    return ev.join(best, "run_id", "left")


def checkpoint_index(log: DataFrame) -> DataFrame:
    """Step → file, with each run's last checkpoint."""
    ck = select_events(log, "checkpoint").select("run_id", "step", "ts", "step_checkpoint", "last_checkpoint", "tokens_seen")
    last = ck.groupBy("run_id").agg(F.max_by("step_checkpoint", "step").alias("latest_file"), F.max("step").alias("latest_step"))
    return ck.join(last, "run_id", "left")


def run_status(log: DataFrame) -> DataFrame:
    """``finished`` when the run logged ``run_finished``, else ``cut_off``."""
    agg = log.groupBy("run_id").agg(
        F.max((F.col("event") == "run_finished").cast("int")).alias("__fin"),
        F.max("final_step").alias("__final"),
        F.max("step").alias("last_step"),
        F.max("ts").alias("last_event_at"),
        F.count(F.lit(1)).alias("events"),
    )
    return agg.select(
        "run_id",
        F.when(F.col("__fin") == 1, F.lit("finished")).otherwise(F.lit("cut_off")).alias("status"),
        F.coalesce(F.col("__final"), F.col("last_step")).alias("final_step"),
        "last_event_at",
        "events",
    )


def resume_lineage(log: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Which run (and step) wrote the checkpoint a run resumed or initialized from:
    the latest write of that path before the resume event (an as-of join keyed by
    path, one row per resume event). A checkpoint event writes two paths: its own step's
    file and the pointer to the last one, through which most runs resume."""
    paths = F.array_distinct(F.array_compact(F.array("step_checkpoint", "last_checkpoint")))
    writes = select_events(log, "checkpoint").select(
        F.explode(paths).alias("path"), "ts", F.lit(0).alias("__kind"), "run_id", "step",
        F.struct(F.col("run_id").alias("parent_run"), F.col("step").alias("parent_step")).alias("__w"),
    )
    reads = select_events(log, "resumed", "initialized_from_checkpoint").select(
        F.col("checkpoint").alias("path"), "ts", F.lit(1).alias("__kind"), "run_id", "step",
        F.lit(None).cast("struct<parent_run:string,parent_step:bigint>").alias("__w"),
        F.col("event").alias("kind"),
    )
    both = writes.withColumn("kind", F.lit(None).cast("string")).unionByName(reads)
    both = both.withColumn("__b", time_bucket("ts", bucket_seconds))
    # Order: time, then writes before reads at the same instant, then run and step.
    looked = last_before(both, ["path"], "__b", ["ts", "__kind", "run_id", "step"], "__w", "__parent")
    return looked.where(F.col("__kind") == 1).select(
        "run_id", "step", "ts", "kind", "path",
        F.col("__parent.parent_run").alias("parent_run"), F.col("__parent.parent_step").alias("parent_step"),
    )


def resume_ancestry(log: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The whole ancestry of every resume: ``run_id, step, ts, root_run, depth``.

    The state a run resumed was written by its parent, which may itself have resumed before
    it wrote; ``depth`` is the number of checkpoints passed from state to state back to
    ``root_run``, the run that began without one (0 and the run itself where nobody wrote the
    path). A parent's resume lies before its write and so before the child's resume: the
    edges have no cycles. Pointer jumping doubles the reach of every edge, so there are as
    many rounds as the logarithm of the deepest chain."""
    found = resume_lineage(log, bucket_seconds).withColumn("id", F.struct("ts", "run_id", "step", "path"))
    writes = select_events(log, "checkpoint").select(F.col("run_id").alias("parent_run"), F.col("step").alias("parent_step"), F.col("ts").alias("written"))
    states = found.join(writes.dropDuplicates(["parent_run", "parent_step"]), ["parent_run", "parent_step"], "left")
    # The parent's last resume before its write.
    asks = states.where(F.col("written").isNotNull()).select(
        F.col("parent_run").alias("run"), F.col("written").alias("at"), F.lit(0).alias("__kind"), "id", F.lit(None).cast(found.schema["id"].dataType).alias("__e")
    )
    gives = found.select(F.col("run_id").alias("run"), F.col("ts").alias("at"), F.lit(1).alias("__kind"), "id", F.col("id").alias("__e"))
    both = asks.unionByName(gives).withColumn("__b", time_bucket("at", bucket_seconds))
    edges = last_before(both, ["run"], "__b", ["at", "__kind", "id"], "__e", "next").where(F.col("__kind") == 0).select("id", "next")
    reach = states.join(edges, "id", "left").select(
        "id", "next", F.coalesce("parent_run", "run_id").alias("root"), F.col("parent_run").isNotNull().cast("long").alias("depth")
    )
    reach = checkpointed(reach, "ancestry")
    while not reach.where(F.col("next").isNotNull()).isEmpty():
        far = reach.select(F.col("id").alias("next"), F.col("next").alias("__next"), F.col("root").alias("__root"), F.col("depth").alias("__depth"))
        reach = reach.join(far, "next", "left").select(
            "id", F.col("__next").alias("next"), F.coalesce("__root", "root").alias("root"), (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth")
        )
        reach = checkpointed(reach, "ancestry")
    return reach.select("id.run_id", "id.step", "id.ts", "id.path", F.col("root").alias("root_run"), "depth")


def interval_loss(log: DataFrame, interval: int) -> DataFrame:
    """Mean logged loss over each block of ``interval`` steps."""
    tr = select_events(log, "train")
    return tr.groupBy("run_id", F.floor((F.col("step") - 1) / F.lit(interval)).cast("long").alias("interval")).agg(
        F.avg("loss").alias("mean_loss"), F.count(F.lit(1)).alias("rows"), F.max("step").alias("last_step")
    )


def throughput(log: DataFrame, tokens_per_step: int, log_interval: int, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Tokens/s per logging interval from the timestamps of consecutive train rows
    (clock floor 1e-6 s). ``after_pause`` marks intervals that contain an eval or a
    checkpoint, whose time the original logger charged to the next interval."""
    rows = select_events(log, "train", "eval", "checkpoint").select("run_id", "ts", "step", "event")
    rows = rows.withColumn("__b", time_bucket("ts", bucket_seconds)).withColumn(
        "__o", F.when(F.col("event") == "train", 1).otherwise(0)
    )
    order = ["ts", "__o", "step"]
    prev_pause = last_before_many(rows, ["run_id"], "__b", order, {
        "prev_train_ts": F.when(F.col("event") == "train", F.col("ts")),
        "prev_pause_ts": F.when(F.col("event") != "train", F.col("ts")),
    })
    tr = prev_pause.where(F.col("event") == "train")
    elapsed = (epoch_micros("ts") - epoch_micros("prev_train_ts")) / F.lit(1e6)
    return tr.select(
        "run_id", "step", "ts",
        elapsed.alias("elapsed_sec"),
        (F.lit(float(tokens_per_step * log_interval)) / F.greatest(elapsed, F.lit(1e-6))).alias("tok_per_sec"),
        (F.col("prev_pause_ts").isNotNull() & (F.col("prev_pause_ts") >= F.col("prev_train_ts"))).alias("after_pause"),
    ).where(F.col("prev_train_ts").isNotNull())


def speed_regression(tput: DataFrame, log: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per run: median tok/s and peak reserved memory, each against the median over
    runs; a run is flagged when its median speed is below ``threshold`` x that."""
    from quire.plans.quantile import exact_quantile

    speed = exact_quantile(tput, ["run_id"], "tok_per_sec", 0.5, "median_tok_per_sec")
    mem = select_events(log, "train").groupBy("run_id").agg(F.max("max_reserved_gb").alias("peak_reserved_gb"))
    # One key for all runs, which no rule folds away: the medians over runs are found by ranks
    # like any others, and come back by an equi-join with one row.
    per_run = checkpointed(speed.join(mem, "run_id", "full"), "run-speeds").withColumn("__all", F.pmod(F.xxhash64("run_id"), F.lit(1)))
    ref = exact_quantile(per_run, ["__all"], "median_tok_per_sec", 0.5, "__speed")
    ref_mem = exact_quantile(per_run, ["__all"], "peak_reserved_gb", 0.5, "__memory")
    return per_run.join(F.broadcast(ref), "__all", "left").join(F.broadcast(ref_mem), "__all", "left").select(
        "run_id", "median_tok_per_sec", "peak_reserved_gb",
        (F.col("median_tok_per_sec") / F.col("__speed")).alias("speed_ratio"),
        (F.col("peak_reserved_gb") / F.col("__memory")).alias("memory_ratio"),
    ).withColumn("slow", F.col("speed_ratio") < F.lit(threshold))


def batch_headroom(log: DataFrame, device_gb: float | None = None) -> DataFrame:
    tr = select_events(log, "train")
    out = tr.groupBy("run_id").agg(
        F.max("allocated_gb").alias("peak_allocated_gb"),
        F.max("reserved_gb").alias("peak_reserved_gb"),
        F.max("max_allocated_gb").alias("max_allocated_gb"),
        F.max("max_reserved_gb").alias("max_reserved_gb"),
    )
    if device_gb is not None:
        out = out.withColumn("headroom_gb", F.lit(device_gb) - F.col("max_reserved_gb"))
    return out


def _bad(c: Column) -> Column:
    return F.isnan(c) | (F.abs(c) == F.lit(float("inf")))


def instability_flags(log: DataFrame, jump: float = 3.0, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Per train row: NaN/inf loss or gradient norm, and a norm jump (more than
    ``jump`` x the previous finite norm of the run)."""
    tr = select_events(log, "train").select("run_id", "step", "ts", "loss", "grad_norm")
    tr = tr.withColumn("__b", time_bucket("ts", bucket_seconds))
    finite = F.when(F.col("grad_norm").isNotNull() & ~_bad(F.col("grad_norm")), F.col("grad_norm"))
    prev = last_before(tr, ["run_id"], "__b", ["ts", "step"], finite, "prev_norm")
    return prev.select(
        "run_id", "step",
        F.coalesce(_bad(F.col("loss")), F.lit(False)).alias("bad_loss"),
        F.coalesce(_bad(F.col("grad_norm")), F.lit(False)).alias("bad_norm"),
        F.coalesce((F.col("grad_norm") > F.lit(jump) * F.col("prev_norm")) & ~_bad(F.col("grad_norm")), F.lit(False)).alias("norm_jump"),
    )


def loss_trend(log: DataFrame, steps: int = 1000, least: int = 3) -> DataFrame:
    """Per train row with a finite loss: the regression of loss on step over the run's rows of
    the last ``steps`` steps; ``not_falling`` when its slope isn't below zero (null with fewer
    than ``least`` rows).

    A run's rows are cut in buckets of ``steps`` steps, and each bucket gets a copy of the one
    before as a halo, so a frame never leaves its bucket and a long run is many tasks' work.
    Losses are taken in units of 2**-20, so sums are whole and the sign is exact."""
    tr = select_events(log, "train").where(~_bad(F.col("loss")) & F.col("step").isNotNull())
    y = F.round(F.col("loss") * F.lit(float(1 << 20))).cast("long")
    bucket = F.floor(F.col("step") / F.lit(steps)).cast("long")
    copies = F.explode(F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("halo")), F.struct((bucket + 1).alias("bucket"), F.lit(True).alias("halo"))))
    rows = tr.select("run_id", "step", y.alias("y"), copies.alias("c")).select("run_id", "step", "y", "c.bucket", "c.halo")
    frame = Window.partitionBy("run_id", "bucket").orderBy("step").rangeBetween(-(steps - 1), 0)
    x = F.col("step") - F.col("bucket") * F.lit(steps)
    total = lambda v: F.sum(v.cast("decimal(20,0)")).over(frame)
    n = F.count(F.lit(1)).over(frame)
    sums = rows.select("run_id", "step", "halo", n.alias("rows"), total(x).alias("sx"), total(F.col("y")).alias("sy"), total(x * F.col("y")).alias("sxy"))
    rising = F.col("rows") * F.col("sxy") >= F.col("sx") * F.col("sy")
    kept = sums.where(~F.col("halo"))
    return kept.select("run_id", "step", "rows", F.when(F.col("rows") >= least, rising).alias("not_falling"))


def cosine_lr(step: Column, warmup: int, max_steps: int, max_lr: float, min_lr: float) -> Column:
    """Warmup then cosine decay (``step`` is 0-based)."""
    s = step.cast("double")
    progress = (s - F.lit(float(warmup))) / F.lit(float(max(1, max_steps - warmup)))
    cosine = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress))
    return (
        F.when(step < F.lit(warmup), F.lit(max_lr) * (s + F.lit(1.0)) / F.lit(float(max(1, warmup))))
        .when(step >= F.lit(max_steps), F.lit(min_lr))
        .otherwise(F.lit(min_lr) + cosine * F.lit(max_lr - min_lr))
    )


def schedule_audit(log: DataFrame, warmup: int, max_steps: int, max_lr: float, min_lr: float, tokens_per_step: int, rtol: float = 1e-6) -> DataFrame:
    """Per run: train rows whose logged lr or tokens_seen differ from the schedule."""
    tr = select_events(log, "train")
    expected = cosine_lr(F.col("step") - 1, warmup, max_steps, max_lr, min_lr)
    lr_bad = F.abs(F.col("lr") - expected) > F.lit(rtol) * F.abs(expected) + F.lit(1e-12)
    tok_bad = F.col("tokens_seen") != F.col("step") * F.lit(tokens_per_step)
    return tr.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.sum(lr_bad.cast("int")).cast("long").alias("lr_mismatches"),
        F.sum(tok_bad.cast("int")).cast("long").alias("tokens_mismatches"),
    )
