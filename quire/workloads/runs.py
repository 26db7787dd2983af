"""Run-analytics workloads over ``events`` (adapted to the metric-log schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import runs as rn
from quire.plans.asof import epoch_micros
from quire.session import scratch_path
from quire.sources.corpus import read_table
from quire.sources.metrics import MAX_LR, TOKENS_PER_STEP, WARMUP_STEPS, metric_log_from_events, read_metrics, write_metrics

LOG_INTERVAL = 10
LOSS_INTERVAL = 100
WARMUP, MAX_STEPS, MIN_LR = WARMUP_STEPS, 20000, 3e-4
TREND_STEPS = 2000


def log(spark: SparkSession, sf: str) -> DataFrame:
    return metric_log_from_events(read_table(spark, sf, "events"))


def _us(c: str):
    return epoch_micros(c).alias(f"{c}_us")


def _nan_null(c: str):
    return F.when(~F.isnan(F.col(c)), F.col(c)).alias(c)


def q_select_events(spark, sf):
    return log(spark, sf).groupBy("event").agg(F.count(F.lit(1)).alias("rows"))


def q_run_index(spark, sf):
    r = rn.run_index(log(spark, sf))
    return r.select("run_id", _us("started_at"), "log_path", "metrics_path")


def q_runtime_summary(spark, sf):
    r = rn.runtime_summary(log(spark, sf))
    return r.select("run_id", _us("ts"), "device", "precision", "parameters", "tokens_per_step", "num_train_shards", "dataset_path", "train_examples", "kind")


def q_train_curve(spark, sf):
    t = rn.train_curve(log(spark, sf))
    return t.select("run_id", "step", _us("ts"), "loss", "lr", _nan_null("grad_norm"),
                    F.isnan("grad_norm").alias("grad_norm_nan"), "tokens_seen", "reserved_gb")


def q_eval_curve(spark, sf):
    e = rn.eval_curve(log(spark, sf))
    return e.select("run_id", "step", "val_loss", F.round("perplexity", 4).alias("perplexity"), "best_step", "best_val_loss")


def q_checkpoint_index(spark, sf):
    c = rn.checkpoint_index(log(spark, sf))
    return c.select("run_id", "step", "step_checkpoint", "tokens_seen", "latest_file", "latest_step")


def q_run_status(spark, sf):
    s = rn.run_status(log(spark, sf))
    return s.select("run_id", "status", "final_step", _us("last_event_at"), "events")


def q_resume_lineage(spark, sf):
    r = rn.resume_lineage(log(spark, sf))
    return r.select("run_id", "step", "path", "parent_run", "parent_step")


def q_resume_ancestry(spark, sf):
    r = rn.resume_ancestry(log(spark, sf))
    return r.select("run_id", "step", "path", "root_run", "depth")


def q_loss_trend(spark, sf):
    return rn.loss_trend(log(spark, sf), TREND_STEPS)


def q_interval_loss(spark, sf):
    i = rn.interval_loss(log(spark, sf), LOSS_INTERVAL)
    return i.select("run_id", "interval", F.round("mean_loss", 9).alias("mean_loss"), "rows", "last_step")


def _tput(spark, sf):
    return rn.throughput(log(spark, sf), TOKENS_PER_STEP, LOG_INTERVAL)


def q_throughput(spark, sf):
    t = _tput(spark, sf)
    return t.select("run_id", "step", "elapsed_sec", "tok_per_sec", "after_pause")


def q_speed_regression(spark, sf):
    lg = log(spark, sf)
    s = rn.speed_regression(rn.throughput(lg, TOKENS_PER_STEP, LOG_INTERVAL), lg)
    return s.select(
        "run_id", F.round("median_tok_per_sec", 3).alias("median_tok_per_sec"), "peak_reserved_gb",
        F.round("speed_ratio", 6).alias("speed_ratio"), F.round("memory_ratio", 6).alias("memory_ratio"), "slow",
    )


def q_batch_headroom(spark, sf):
    return rn.batch_headroom(log(spark, sf))


def q_instability_flags(spark, sf):
    return rn.instability_flags(log(spark, sf))


def q_schedule_audit(spark, sf):
    return rn.schedule_audit(log(spark, sf), WARMUP, MAX_STEPS, MAX_LR, MIN_LR, TOKENS_PER_STEP)


def q_read_metrics(spark, sf):
    """Write the log as JSONL files (every line names its run) and read it back."""
    path = scratch_path(spark, "metrics")
    write_metrics(log(spark, sf), path, mode="overwrite")
    back = read_metrics(spark, path)
    return back.groupBy("run_id", "event").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.isnan("grad_norm"), 1).otherwise(0)).cast("long").alias("nan_norms"),
        F.max("step").alias("max_step"),
    )


def q_write_metrics(spark, sf):
    """Write the log as JSONL (every line names its run) and count the written lines."""
    path = scratch_path(spark, "metrics-out")
    write_metrics(log(spark, sf), path, mode="overwrite")
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    run = F.get_json_object("value", "$.run_id")
    return lines.select(run.alias("run_id"), "value").groupBy("run_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.col("value").contains('"event":"train"').cast("int")).cast("long").alias("train_lines"),
    )


QUERIES = {
    "write_metrics": q_write_metrics,
    "select_events": q_select_events,
    "run_index": q_run_index,
    "runtime_summary": q_runtime_summary,
    "train_curve": q_train_curve,
    "eval_curve": q_eval_curve,
    "checkpoint_index": q_checkpoint_index,
    "run_status": q_run_status,
    "resume_lineage": q_resume_lineage,
    "resume_ancestry": q_resume_ancestry,
    "loss_trend": q_loss_trend,
    "interval_loss": q_interval_loss,
    "throughput": q_throughput,
    "speed_regression": q_speed_regression,
    "batch_headroom": q_batch_headroom,
    "instability_flags": q_instability_flags,
    "schedule_audit": q_schedule_audit,
    "read_metrics": q_read_metrics,
}

# ---------------------------------------------------------------- SQL side

LOG = f"""
WITH base AS (
  SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, ts, event_id, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'run_started' WHEN 'view' THEN 'train' WHEN 'click' THEN 'eval'
                         WHEN 'purchase' THEN 'checkpoint' WHEN 'error' THEN 'resumed' END AS event0
  FROM events),
exploded AS (
  SELECT *, unnest(CASE WHEN event0 = 'run_started' THEN ['run_started', 'runtime_summary']
                         WHEN event0 = 'checkpoint' AND k >= 90 THEN ['checkpoint', 'run_finished'] ELSE [event0] END) AS event
  FROM base WHERE event0 IS NOT NULL),
lg AS (
  SELECT run_id, ts, epoch_us(ts) AS ts_us, event, value, k,
         CASE WHEN event IN ('train', 'eval', 'checkpoint', 'resumed') THEN event_id END AS step,
         CASE WHEN event = 'run_finished' THEN event_id END AS final_step,
         printf('ckpt/slot_%02d.pt', k) AS slot,
         CASE WHEN k % 4 = 0 THEN 'ckpt/last.pt' ELSE printf('ckpt/slot_%02d.pt', k) END AS resumed_path,
         CASE WHEN k % 2 = 0 AND event_id <= {WARMUP} THEN {MAX_LR!r} * CAST(event_id AS DOUBLE) / {float(WARMUP)!r} ELSE value / 10000.0 END AS lr,
         event_id * {TOKENS_PER_STEP} + CASE WHEN k = 50 THEN 1 ELSE 0 END AS train_tokens,
         CASE WHEN k = 0 THEN CAST('NaN' AS DOUBLE) ELSE k / 10.0 END AS gn
  FROM exploded),
train AS (SELECT * FROM lg WHERE event = 'train'),
tp AS (
  SELECT run_id, ts, ts_us, step, event, CASE WHEN event = 'train' THEN 1 ELSE 0 END AS o FROM lg
  WHERE event IN ('train', 'eval', 'checkpoint')),
tp2 AS (
  SELECT *,
    last_value(CASE WHEN event = 'train' THEN ts_us END IGNORE NULLS) OVER w AS prev_train_us,
    last_value(CASE WHEN event <> 'train' THEN ts_us END IGNORE NULLS) OVER w AS prev_pause_us
  FROM tp WINDOW w AS (PARTITION BY run_id ORDER BY ts, o, step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tput AS (
  SELECT run_id, step, (ts_us - prev_train_us) / 1e6 AS elapsed_sec,
         {float(TOKENS_PER_STEP * LOG_INTERVAL)!r} / greatest((ts_us - prev_train_us) / 1e6, 1e-6) AS tok_per_sec,
         prev_pause_us IS NOT NULL AND prev_pause_us >= prev_train_us AS after_pause
  FROM tp2 WHERE event = 'train' AND prev_train_us IS NOT NULL)
"""

LINEAGE = """, io AS (
                              SELECT unnest([slot, 'ckpt/last.pt']) AS path, ts, 0 AS kind, run_id, step,
                                     {'run': run_id, 'step': step, 'ts': ts} AS w FROM lg WHERE event = 'checkpoint'
                              UNION ALL
                              SELECT resumed_path, ts, 1, run_id, step, NULL FROM lg WHERE event = 'resumed'),
                            resumes AS (
                              SELECT run_id, step, path, ts, p.run AS parent_run, p.step AS parent_step, p.ts AS parent_ts FROM (
                                SELECT *, last_value(w IGNORE NULLS) OVER o AS p
                                FROM io WINDOW o AS (PARTITION BY path ORDER BY ts, kind, run_id, step
                                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
                              WHERE kind = 1)
"""

_COS = f"""CASE WHEN step - 1 < {WARMUP} THEN {MAX_LR!r} * (CAST(step - 1 AS DOUBLE) + 1.0) / {float(WARMUP)!r}
             WHEN step - 1 >= {MAX_STEPS} THEN {MIN_LR!r}
             ELSE {MIN_LR!r} + 0.5 * (1.0 + cos(pi() * ((CAST(step - 1 AS DOUBLE) - {float(WARMUP)!r}) / {float(MAX_STEPS - WARMUP)!r}))) * {MAX_LR - MIN_LR!r} END"""

SQL = {
    "write_metrics": LOG + """SELECT run_id, CAST(count(*) AS BIGINT) AS lines,
                              CAST(count(*) FILTER (WHERE event = 'train') AS BIGINT) AS train_lines FROM lg GROUP BY run_id""",
    "select_events": LOG + "SELECT event, CAST(count(*) AS BIGINT) AS rows FROM lg GROUP BY event",
    "run_index": LOG + """SELECT run_id, ts_us AS started_at_us, 'logs/' || run_id || '.log' AS log_path,
                              'logs/' || run_id || '.jsonl' AS metrics_path FROM lg WHERE event = 'run_started'""",
    "runtime_summary": LOG + f"""SELECT run_id, ts_us, CASE WHEN k % 5 = 0 THEN 'mps' ELSE 'cuda' END AS device,
                              CASE WHEN k % 2 = 0 THEN 'bf16' ELSE 'fp32' END AS precision, CAST(75571584 AS BIGINT) AS parameters,
                              CAST({TOKENS_PER_STEP} AS BIGINT) AS tokens_per_step, CASE WHEN k % 3 <> 0 THEN k + 1 END AS num_train_shards,
                              CASE WHEN k % 3 = 0 THEN 'data/sft' END AS dataset_path, CASE WHEN k % 3 = 0 THEN k * 100 END AS train_examples,
                              CASE WHEN k % 3 = 0 THEN 'sft' ELSE 'pretrain' END AS kind
                              FROM lg WHERE event = 'runtime_summary'""",
    "train_curve": LOG + f"""SELECT run_id, step, ts_us, value AS loss, lr,
                              CASE WHEN isnan(gn) THEN NULL ELSE gn END AS grad_norm, isnan(gn) AS grad_norm_nan,
                              train_tokens AS tokens_seen, value / 10.0 AS reserved_gb FROM train""",
    "eval_curve": LOG + """SELECT e.run_id, e.step, e.value AS val_loss, round(exp(least(e.value, 20.0)), 4) AS perplexity,
                              b.best_step, b.best_val_loss
                            FROM lg e JOIN (
                              SELECT run_id, arg_min(step, (value, step)) AS best_step, min(value) AS best_val_loss
                              FROM lg WHERE event = 'eval' GROUP BY run_id) b USING (run_id)
                            WHERE e.event = 'eval'""",
    "checkpoint_index": LOG + f"""SELECT c.run_id, c.step, c.slot AS step_checkpoint, c.step * {TOKENS_PER_STEP} AS tokens_seen,
                              l.latest_file, l.latest_step
                            FROM lg c JOIN (SELECT run_id, arg_max(slot, step) AS latest_file, max(step) AS latest_step
                                            FROM lg WHERE event = 'checkpoint' GROUP BY run_id) l USING (run_id)
                            WHERE c.event = 'checkpoint'""",
    "run_status": LOG + """SELECT run_id, CASE WHEN count(*) FILTER (WHERE event = 'run_finished') > 0 THEN 'finished' ELSE 'cut_off' END AS status,
                              coalesce(max(final_step), max(step)) AS final_step, max(ts_us) AS last_event_at_us,
                              CAST(count(*) AS BIGINT) AS events FROM lg GROUP BY run_id""",
    "resume_lineage": LOG + LINEAGE + "SELECT run_id, step, path, parent_run, parent_step FROM resumes",
    # Each resume's next one: the parent's last resume before it wrote; then recursion.
    "resume_ancestry": LOG.replace("WITH base", "WITH RECURSIVE base") + LINEAGE.rstrip() + """,
                            rs AS (SELECT *, row_number() OVER (ORDER BY ts, run_id, step) AS id FROM resumes),
                            st AS (
                              SELECT r.*, (SELECT arg_max(x.id, (x.ts, x.id)) FROM rs x WHERE x.run_id = r.parent_run AND x.ts < r.parent_ts) AS next FROM rs r),
                            up AS (
                              SELECT id, next, coalesce(parent_run, run_id) AS root, CASE WHEN parent_run IS NULL THEN 0 ELSE 1 END AS depth FROM st
                              UNION ALL
                              SELECT up.id, st.next, coalesce(st.parent_run, st.run_id), up.depth + CASE WHEN st.parent_run IS NULL THEN 0 ELSE 1 END
                              FROM up JOIN st ON st.id = up.next)
                            SELECT rs.run_id, rs.step, rs.path, up.root AS root_run, CAST(up.depth AS BIGINT) AS depth
                            FROM up JOIN rs USING (id) WHERE up.next IS NULL""",
    "loss_trend": LOG + f"""SELECT run_id, step, CAST(n AS BIGINT) AS rows, CASE WHEN n >= 3 THEN n * sxy >= sx * sy END AS not_falling
                            FROM (SELECT run_id, step, count(*) OVER w AS n, sum(CAST(step AS HUGEINT)) OVER w AS sx, sum(CAST(y AS HUGEINT)) OVER w AS sy,
                                         sum(CAST(step AS HUGEINT) * y) OVER w AS sxy
                                  FROM (SELECT *, CAST(round(value * 1048576.0) AS BIGINT) AS y FROM train WHERE NOT isnan(value) AND NOT isinf(value))
                                  WINDOW w AS (PARTITION BY run_id ORDER BY step RANGE BETWEEN {TREND_STEPS - 1} PRECEDING AND CURRENT ROW))""",
    "interval_loss": LOG + f"""SELECT run_id, CAST((step - 1) // {LOSS_INTERVAL} AS BIGINT) AS interval, round(avg(value), 9) AS mean_loss,
                              CAST(count(*) AS BIGINT) AS rows, max(step) AS last_step FROM train GROUP BY 1, 2""",
    "throughput": LOG + "SELECT run_id, step, elapsed_sec, tok_per_sec, after_pause FROM tput",
    "speed_regression": LOG + """, sp AS (SELECT run_id, quantile_cont(tok_per_sec, 0.5) AS m FROM tput GROUP BY run_id),
                              mem AS (SELECT run_id, max(value / 10.0) AS peak FROM train GROUP BY run_id),
                              pr AS (SELECT * FROM sp FULL JOIN mem USING (run_id))
                            SELECT run_id, round(m, 3) AS median_tok_per_sec, peak AS peak_reserved_gb,
                                   round(m / (SELECT quantile_cont(m, 0.5) FROM pr), 6) AS speed_ratio,
                                   round(peak / (SELECT quantile_cont(peak, 0.5) FROM pr), 6) AS memory_ratio,
                                   m / (SELECT quantile_cont(m, 0.5) FROM pr) < 0.9 AS slow
                            FROM pr""",
    "batch_headroom": LOG + """SELECT run_id, max(value / 20.0) AS peak_allocated_gb, max(value / 10.0) AS peak_reserved_gb,
                              max(value / 20.0) AS max_allocated_gb, max(value / 10.0) AS max_reserved_gb FROM train GROUP BY run_id""",
    "instability_flags": LOG + """SELECT run_id, step, isnan(value) OR isinf(value) AS bad_loss, isnan(gn) OR isinf(gn) AS bad_norm,
                              coalesce(gn > 3.0 * prev AND NOT (isnan(gn) OR isinf(gn)), false) AS norm_jump
                            FROM (SELECT *, last_value(CASE WHEN NOT (isnan(gn) OR isinf(gn)) THEN gn END IGNORE NULLS)
                                    OVER (PARTITION BY run_id ORDER BY ts, step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
                                  FROM train)""",
    "schedule_audit": LOG + f"""SELECT run_id, CAST(count(*) AS BIGINT) AS train_rows,
                              CAST(sum(CASE WHEN abs(lr - ({_COS})) > 1e-6 * abs({_COS}) + 1e-12 THEN 1 ELSE 0 END) AS BIGINT) AS lr_mismatches,
                              CAST(sum(CASE WHEN train_tokens <> step * {TOKENS_PER_STEP} THEN 1 ELSE 0 END) AS BIGINT) AS tokens_mismatches
                            FROM train GROUP BY run_id""",
    "read_metrics": LOG + """SELECT run_id, event, CAST(count(*) AS BIGINT) AS rows,
                              CAST(sum(CASE WHEN event = 'train' AND isnan(gn) THEN 1 ELSE 0 END) AS BIGINT) AS nan_norms,
                              max(step) AS max_step FROM lg GROUP BY run_id, event""",
}
