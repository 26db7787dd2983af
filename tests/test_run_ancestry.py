"""Ancestry of resumes, loss trends and quantiles with ties, on hand-made logs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import runs as rn
from quire.plans.quantile import exact_quantile

LOG = "run_id string, ts timestamp_ntz, event string, step long, loss double, step_checkpoint string, last_checkpoint string, checkpoint string"
T0 = dt.datetime(2025, 1, 1)


def row(run, hour, event, step, **more):
    return (run, T0 + dt.timedelta(hours=hour), event, step, more.get("loss"), more.get("file"), more.get("last"), more.get("path"))


def test_ancestry_through_step_files_and_the_pointer(spark):
    rows = [
        row("a", 1, "checkpoint", 10, file="a10", last="last"),
        row("b", 2, "resumed", 10, path="a10"),  # b <- a
        row("b", 3, "checkpoint", 20, file="b20", last="last"),
        row("c", 4, "resumed", 20, path="last"),  # c <- b <- a, through the pointer
        row("c", 50, "checkpoint", 30, file="c30", last="last"),
        row("a", 60, "resumed", 30, path="last"),  # a goes on from c: no cycle, a is older
        row("a", 61, "checkpoint", 40, file="a40", last="last"),
        row("d", 70, "initialized_from_checkpoint", 0, path="a40"),  # d <- a <- c <- b <- a
        row("d", 71, "resumed", 5, path="a10"),  # an old file: d <- a
        row("e", 80, "resumed", 1, path="nowhere"),
        row("f", 4, "checkpoint", 5, file="f5", last="f-last"),
    ]
    chain = [row("r0", 100, "checkpoint", 0, file="s0", last=None)]
    for i in range(1, 40):  # a deep chain, several hours apart
        chain += [row(f"r{i}", 100 + 9 * i, "resumed", i, path=f"s{i - 1}"), row(f"r{i}", 101 + 9 * i, "checkpoint", i, file=f"s{i}", last=None)]
    log = spark.createDataFrame(rows + chain, LOG).repartition(4)
    got = {(r.run_id, r.step): (r.root_run, r.depth) for r in rn.resume_ancestry(log).collect()}
    assert {k: v for k, v in got.items() if k[0][0] != "r"} == {
        ("b", 10): ("a", 1), ("c", 20): ("a", 2), ("a", 30): ("a", 3), ("d", 0): ("a", 4), ("d", 5): ("a", 1), ("e", 1): ("e", 0),
    }
    assert {k: v for k, v in got.items() if k[0][0] == "r"} == {(f"r{i}", i): ("r0", i) for i in range(1, 40)}
    assert rn.resume_ancestry(log.where("run_id = 'f'")).count() == 0


def test_loss_trend_equals_a_moving_regression(spark):
    rng = random.Random(1)
    steps = sorted(rng.sample(range(5000), 400))
    rows = [row("x", 0, "train", s, loss=round(5 - s / 2000 + rng.gauss(0, 0.4), 3)) for s in steps]
    rows += [row("y", 0, "train", 1, loss=2.0), row("y", 0, "train", 2, loss=float("nan")), row("y", 0, "train", 3, loss=1.0), row("y", 0, "train", 4, loss=None)]
    got = {(r.run_id, r.step): (r.rows, r.not_falling) for r in rn.loss_trend(spark.createDataFrame(rows, LOG), 300, 3).collect()}
    losses = {r[3]: r[4] for r in rows if r[0] == "x"}
    for s in steps:
        w = [t for t in steps if s - 300 < t <= s]
        mx, my = sum(w) / len(w), sum(losses[t] for t in w) / len(w)
        slope = sum((t - mx) * (losses[t] - my) for t in w)
        rows_, flag = got["x", s]
        assert rows_ == len(w) and (flag is None if len(w) < 3 else abs(slope) < 1e-3 or flag == (slope >= 0))
    assert {k: v for k, v in got.items() if k[0] == "y"} == {("y", 1): (1, None), ("y", 3): (2, None)}


@pytest.mark.parametrize("p", [0.0, 0.3, 0.5, 1.0])
def test_equal_values_are_one_row(spark, p):
    import numpy as np

    values = [7.0] * 5000 + [1.0, 2.5, 2.5, 900.0, -3.0, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").withColumn("k", F.lit("a"))
    assert exact_quantile(df, ["k"], "v", p, "q").first().q == pytest.approx(np.quantile(values, p))


def test_speeds_need_no_global_window(spark):
    log = spark.createDataFrame([(f"r{i}", "train", float(i)) for i in range(9)], "run_id string, event string, max_reserved_gb double")
    tput = spark.createDataFrame([(f"r{i % 9}", 10.0) for i in range(90)], "run_id string, tok_per_sec double")
    out = rn.speed_regression(tput, log)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "NestedLoop" not in plan
    rows = {r.run_id: r for r in out.collect()}
    assert len(rows) == 9 and all(r.speed_ratio == 1.0 and not r.slow for r in rows.values()) and rows["r8"].memory_ratio == 2.0
