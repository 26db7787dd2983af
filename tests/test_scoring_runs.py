"""Scoring aggregates and run analytics on hand-written fixtures."""

import datetime as dt
import math


from quire.operators import runs as rn
from quire.operators import scoring as sc
from quire.sources.metrics import METRIC_COLUMNS


def test_choice_accuracy_ties_to_lowest_index(spark):
    rows = [("m", "t", 1, 0, 1, 0, 10, -1.0, True), ("m", "t", 1, 1, 1, 0, 11, -1.0, True),
            ("m", "t", 2, 0, 0, 0, 10, -2.0, True), ("m", "t", 2, 1, 0, 0, 11, -1.0, True)]
    ts = spark.createDataFrame(rows, "model string, task string, request_id long, choice int, gold int, pos int, token_id int, logprob double, is_choice boolean")
    preds = {r.request_id: r.pred for r in sc.predictions(sc.choice_loglik(ts)).collect()}
    assert preds == {1: 0, 2: 1}
    acc = sc.choice_accuracy(sc.choice_loglik(ts)).first()
    assert acc.acc == 0.0


def test_rolling_single_token_is_zero(spark):
    rows = [("m", "t", 1, 0, -3.0), ("m", "t", 2, 0, -3.0), ("m", "t", 2, 1, -0.5)]
    df = spark.createDataFrame(rows, "model string, task string, request_id long, pos int, logprob double")
    got = {r.request_id: r.ll for r in sc.rolling_loglik(df).collect()}
    assert got == {1: 0.0, 2: -0.5}


def test_perplexity_cap(spark):
    df = spark.createDataFrame([(2.0,), (50.0,)], "l double").select(sc.perplexity("l").alias("p"))
    p = [r.p for r in df.collect()]
    assert abs(p[0] - math.exp(2.0)) < 1e-9 and abs(p[1] - math.exp(20.0)) < 1e-3


def _log(spark, rows):
    base = {c: None for c in METRIC_COLUMNS}
    out = []
    for r in rows:
        x = dict(base)
        x.update(r)
        out.append(tuple(x[c] for c in METRIC_COLUMNS))
    from quire.sources.metrics import METRIC_SCHEMA
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("ts", T.TimestampNTZType())] + list(METRIC_SCHEMA.fields))
    return spark.createDataFrame(out, schema)


def test_resume_lineage_as_of(spark):
    t = lambda m: dt.datetime(2025, 1, 1, 0, m)
    rows = [
        {"run_id": "A", "ts": t(1), "event": "checkpoint", "step": 100, "step_checkpoint": "c/step_100.pt"},
        {"run_id": "B", "ts": t(5), "event": "checkpoint", "step": 7, "step_checkpoint": "c/step_100.pt"},
        {"run_id": "C", "ts": t(3), "event": "resumed", "step": 100, "checkpoint": "c/step_100.pt"},
        {"run_id": "D", "ts": t(9), "event": "initialized_from_checkpoint", "checkpoint": "c/step_100.pt"},
        {"run_id": "E", "ts": t(9), "event": "resumed", "step": 1, "checkpoint": "c/none.pt"},
    ]
    got = {r.run_id: (r.parent_run, r.parent_step) for r in rn.resume_lineage(_log(spark, rows), bucket_seconds=120).collect()}
    assert got == {"C": ("A", 100), "D": ("B", 7), "E": (None, None)}


def test_throughput_and_flags(spark):
    t = lambda s: dt.datetime(2025, 1, 1, 0, 0, s)
    rows = [
        {"run_id": "A", "ts": t(0), "event": "train", "step": 10, "loss": 5.0, "grad_norm": 1.0},
        {"run_id": "A", "ts": t(4), "event": "eval", "step": 10, "val_loss": 4.0},
        {"run_id": "A", "ts": t(10), "event": "train", "step": 20, "loss": float("nan"), "grad_norm": 4.0},
        {"run_id": "A", "ts": t(10), "event": "train", "step": 30, "loss": 4.0, "grad_norm": float("nan")},
    ]
    log = _log(spark, rows)
    tp = {r.step: r for r in rn.throughput(log, 100, 10, bucket_seconds=5).collect()}
    assert tp[20].elapsed_sec == 10.0 and tp[20].after_pause and tp[20].tok_per_sec == 100.0
    assert tp[30].tok_per_sec == 1000 / 1e-6 and not tp[30].after_pause
    fl = {r.step: r for r in rn.instability_flags(log, bucket_seconds=5).collect()}
    assert fl[20].bad_loss and fl[20].norm_jump and not fl[10].norm_jump and fl[30].bad_norm


def test_schedule_audit_exact_schedule(spark):
    """Ten warm-up steps to 1e-3, then a cosine to 1e-4 at step 100 (values worked out by
    hand: half way down is the mean, a sixth of the way is at cos 30 degrees)."""
    logged = [(1, 1e-4), (5, 5e-4), (10, 1e-3), (11, 1e-3), (26, 1e-4 + 4.5e-4 * (1 + 0.8660254037844387)), (56, 5.5e-4), (150, 1e-4)]
    rows = [{"run_id": "A", "ts": dt.datetime(2025, 1, 1), "event": "train", "step": s, "lr": v, "tokens_seen": s * 8} for s, v in logged]
    rows.append({"run_id": "A", "ts": dt.datetime(2025, 1, 1), "event": "train", "step": 60, "lr": 0.5, "tokens_seen": 1})
    r = rn.schedule_audit(_log(spark, rows), 10, 100, 1e-3, 1e-4, 8).first()
    assert (r.train_rows, r.lr_mismatches, r.tokens_mismatches) == (8, 1, 1)


def test_resume_through_the_pointer_to_the_last_checkpoint(spark):
    t = lambda m: dt.datetime(2025, 1, 1, 0, m)
    rows = [
        {"run_id": "A", "ts": t(1), "event": "checkpoint", "step": 100, "step_checkpoint": "c/step_100.pt", "last_checkpoint": "c/last.pt"},
        {"run_id": "A", "ts": t(2), "event": "checkpoint", "step": 200, "step_checkpoint": "c/step_200.pt", "last_checkpoint": "c/last.pt"},
        {"run_id": "B", "ts": t(5), "event": "resumed", "step": 200, "checkpoint": "c/last.pt"},
        {"run_id": "C", "ts": t(6), "event": "resumed", "step": 100, "checkpoint": "c/step_100.pt"},
    ]
    got = {r.run_id: (r.parent_run, r.parent_step) for r in rn.resume_lineage(_log(spark, rows)).collect()}
    assert got == {"B": ("A", 200), "C": ("A", 100)}


def test_merged_version_is_the_last_one_given(spark):
    rows = [("m", "a.json", "t", 0.5, None, 1), ("m", "b.json", "t", 0.9, 0.1, 2), ("m", "c.json", "t", 0.7, 0.1, None)]
    df = spark.createDataFrame(rows, "model string, file string, task string, acc double, acc_stderr double, version long")
    r = sc.merge_results(df).first()
    assert (r.file, r.acc, r.acc_stderr, r.version) == ("a.json", 0.5, None, 2)


def test_exact_quantile_matches_numpy_with_hot_key(spark):
    import numpy as np

    from quire.plans.quantile import exact_quantile

    rng = np.random.default_rng(1)
    rows = [("hot", i, float(v)) for i, v in enumerate(rng.lognormal(3, 1, 3000))]
    rows += [("cold", 10_000 + i, float(v)) for i, v in enumerate(rng.lognormal(1, 0.5, 7))]
    rows += [("one", 20_000, 5.0), ("ties", 30_000, 2.0), ("ties", 30_001, 2.0)]
    df = spark.createDataFrame(rows, "k string, id long, v double")
    for p in (0.5, 0.1, 0.99):
        got = {r.k: r.q for r in exact_quantile(df, ["k"], "v", p, "q", tiebreak="id").collect()}
        for k in ("hot", "cold", "one", "ties"):
            vals = [v for kk, _, v in rows if kk == k]
            assert abs(got[k] - float(np.percentile(vals, p * 100))) < 1e-9 * max(1.0, abs(got[k]))


def test_cap_samples_is_limited_before_shuffle(spark):
    rows = [("m", "t", i, 0, 0, 0.0) for i in range(50)]
    df = spark.createDataFrame(rows, "model string, task string, request_id long, choice int, gold int, ll double")
    capped = sc.cap_samples(df, 5)
    assert sorted(r.request_id for r in capped.collect()) == [0, 1, 2, 3, 4]
