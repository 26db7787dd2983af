"""Shard round trips, metric/result files and streaming restarts."""

import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import scoring as sc
from quire.sources import shards as sh
from quire.sources.eval_results import read_eval_results, write_eval_results
from quire.sources.growing import read_growing_metrics
from quire.sources.metrics import METRIC_SCHEMA, read_metrics, write_metrics
from quire.streaming import streams as st


def _tmp():
    return tempfile.mkdtemp(prefix="quire-test-", dir="/tmp")


def test_token_shards_round_trip(spark):
    out = _tmp()
    rng = np.random.default_rng(0)
    toks = rng.integers(0, 65536, size=2500).tolist()
    pieces = [(i // 1000, i % 1000, toks[i:i + 100]) for i in range(0, 2500, 100)]
    df = spark.createDataFrame(pieces, "shard long, shard_pos long, tokens array<int>")
    sh.write_token_shards(df, out, "train")
    man = json.load(open(os.path.join(out, "train_manifest.json")))
    assert man == [{"path": "train_00000.bin", "num_tokens": 1000, "dtype": "uint16"},
                   {"path": "train_00001.bin", "num_tokens": 1000, "dtype": "uint16"},
                   {"path": "train_00002.bin", "num_tokens": 500, "dtype": "uint16"}]
    assert np.fromfile(os.path.join(out, "train_00001.bin"), dtype="<u2").tolist() == toks[1000:2000]
    chunks = sh.read_token_shards(spark, out, "train", chunk_tokens=256, partition_tokens=512).orderBy("shard", "start").collect()
    assert [t for r in chunks for t in r.tokens] == toks
    assert not os.listdir(os.path.join(out, "_temporary"))
    win = sh.read_token_shards(spark, out, "train", mode="windows", seq_len=100).orderBy("window_idx").collect()
    # shard 0/1: starts 0..800 (max_start 899); shard 2: starts 0..300 (max_start 399)
    assert [(r.shard, r.start) for r in win][:2] == [(0, 0), (0, 100)]
    assert len(win) == 9 + 9 + 4
    assert all(len(r.input_ids) == 100 and list(r.labels[:-1]) == list(r.input_ids[1:]) for r in win)


def test_token_shards_reject_large_ids(spark):
    df = spark.createDataFrame([(0, 0, [70000])], "shard long, shard_pos long, tokens array<int>")
    with pytest.raises(Exception):
        sh.write_token_shards(df, _tmp(), "train")


def test_manifest_lookup_places():
    d = _tmp()
    os.makedirs(os.path.join(d, "val"))
    json.dump([{"path": "val_00000.bin", "num_tokens": 3, "dtype": "uint16"}], open(os.path.join(d, "val", "val_manifest.json"), "w"))
    assert sh.load_manifest(d, "val")[0]["num_tokens"] == 3
    assert sh.load_manifest(os.path.join(d, "val"), "val")[0]["path"] == "val_00000.bin"
    with pytest.raises(FileNotFoundError):
        sh.load_manifest(d, "train")


def test_sft_shards_round_trip(spark):
    out = _tmp()
    L = 6
    rows = [(i, [i + 1] * 3 + [0] * 3, [-100, i, i, -100, -100, -100]) for i in range(23)]
    df = spark.createDataFrame(rows, "row long, input_ids array<int>, labels array<int>")
    sh.write_sft_shards(df.repartition(3), out, "train", L)
    meta = json.load(open(os.path.join(out, "train_metadata.json")))
    assert meta["num_examples"] == 23 and meta["seq_len"] == L
    back = sh.read_sft_shards(spark, out, "train", rows_per_partition=5).orderBy("row").collect()
    assert [(r.row, list(r.input_ids), list(r.labels)) for r in back] == [(a, b, c) for a, b, c in rows]
    assert list(back[0].attention_mask) == [1, 1, 1, 0, 0, 0]
    bad = spark.createDataFrame([(0, [1, 2], [1, 2])], "row long, input_ids array<int>, labels array<int>")
    with pytest.raises(Exception):
        sh.write_sft_shards(bad, _tmp(), "train", L)


def test_read_metrics_nan_and_run_key(spark):
    d = _tmp()
    lines = [
        {"event": "run_started", "timestamp": "2025-01-01T00:00:00"},
        {"event": "train", "timestamp": "2025-01-01T00:01:00", "step": 10, "loss": 3.5, "grad_norm": float("nan")},
        {"event": "run_finished", "timestamp": "2025-01-01T00:02:00", "final_step": 10, "tokens_seen": 5},
    ]
    with open(os.path.join(d, "train_pretrain_20250101_000000.jsonl"), "w") as fh:
        for x in lines:
            fh.write(json.dumps(x) + "\n")
    df = read_metrics(spark, d)
    rows = df.orderBy("ts").collect()
    assert {r.run_id for r in rows} == {"train_pretrain_20250101_000000"}
    assert np.isnan(rows[1].grad_norm) and rows[1].loss == 3.5 and rows[2].final_step == 10


def test_eval_results_merge_semantics(spark):
    d = _tmp()
    rows = [
        ("m", "m/results_a.json", "t1|0", 0.5, 0.1, 1), ("m", "m/results_a.json", "all", 0.9, 0.0, 1),
        ("m", "m/results_b.json", "t1|0", 0.7, None, 2), ("m", "m/results_b.json", "mmlu:x|0", 0.4, None, 2),
    ]
    src = spark.createDataFrame(rows, "model string, file string, task string, acc double, acc_stderr double, version long")
    write_eval_results(src, d)
    back = read_eval_results(spark, d)
    merged = {r.task: r for r in sc.merge_results(back).collect()}
    assert set(merged) == {"t1|0", "mmlu:x|0"}
    assert merged["t1|0"].acc == 0.5 and merged["t1|0"].version == 2
    allrow = sc.overall_accuracy(sc.merge_results(back)).first()
    assert abs(allrow.acc - 0.45) < 1e-12 and abs(allrow.acc_stderr - (0.01 / 2) ** 0.5) < 1e-12


def test_stream_corpus_restart_adds_nothing(spark):
    from quire.functions.tokenizers import ByteTokenizer

    src, out, ck = _tmp(), _tmp(), _tmp()
    spark.createDataFrame([("a", 1, " x "), ("a", 2, "  ")], "source string, doc_id long, text string").write.mode("append").parquet(src)
    schema = "source string, doc_id long, text string"
    run = lambda: st.stream_corpus(st.read_corpus_stream(spark, src, schema), ByteTokenizer(), out, ck).awaitTermination()
    run()
    assert spark.read.parquet(out).count() == 1
    run()  # nothing new: no duplicates
    assert spark.read.parquet(out).count() == 1
    spark.createDataFrame([("b", 3, "yz")], schema).write.mode("append").parquet(src)
    run()
    got = sorted((r.doc_id, list(r.ids)) for r in spark.read.parquet(out).collect())
    assert got == [(1, [1, ord("x") + 4, 2]), (3, [1, ord("y") + 4, ord("z") + 4, 2])]


def test_random_windows_gathered_from_files(spark):
    from quire.operators.windows import random_windows

    out = _tmp()
    rng = np.random.default_rng(3)
    toks = rng.integers(0, 65536, size=3000).tolist()
    pieces = [(i // 1000, i % 1000, toks[i:i + 50]) for i in range(0, 3000, 50)]
    sh.write_token_shards(spark.createDataFrame(pieces, "shard long, shard_pos long, tokens array<int>"), out, "train")
    man = spark.createDataFrame([("train", k, 1000) for k in range(3)], "split string, shard long, num_tokens long")
    L = 32
    draws = random_windows(spark, man, 200, L, seed=1)
    got = sh.gather_windows(draws, out, "train", L).collect()
    assert len(got) == 200
    for r in got:
        base = r.shard * 1000 + r.start
        assert 0 <= r.start < 1000 - L - 1
        assert list(r.input_ids) == toks[base:base + L] and list(r.labels) == toks[base + 1:base + L + 1]


def test_random_windows_on_a_large_manifest_stay_distributed(spark):
    """600,000 shards: planned and drawn without collecting or broadcasting the manifest."""
    from quire.operators.windows import random_windows, sequential_window_counts

    man = spark.range(600_000).selectExpr("'train' AS split", "id AS shard", "100 + id % 7 AS num_tokens")
    draws = random_windows(spark, man, 50, 32, seed=3)
    plan = draws._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    rows = draws.collect()
    assert len(rows) == 50 and all(0 <= r.start < 100 + r.shard % 7 - 33 for r in rows)
    counts = sequential_window_counts(man, 32)
    assert counts.agg({"n_windows": "sum"}).first()[0] == counts.agg({"first_idx": "max"}).first()[0] + counts.where("shard = 599999").first().n_windows


def test_random_windows_without_room_fail(spark):
    import pytest

    from quire.operators.windows import random_windows

    man = spark.createDataFrame([("train", 0, 10)], "split string, shard long, num_tokens long")
    with pytest.raises(Exception, match="room"):
        random_windows(spark, man, 3, 32, seed=3).collect()


def test_results_below_a_folder_with_odd_characters(spark, tmp_path):
    import json

    from quire.sources.eval_results import read_eval_results

    root = tmp_path / "it's 100% a+b"
    (root / "x y").mkdir(parents=True)
    doc = {"config_general": {"model_name": "m"}, "results": {"t": {"acc": 0.5}}, "versions": {"t": 1}}
    (root / "x y" / "results_1.json").write_text(json.dumps(doc))
    assert [r.file for r in read_eval_results(spark, str(root)).collect()] == ["x y/results_1.json"]


def test_sft_files_are_plain_arrays_whatever_the_distribution(spark, tmp_path):
    rng = np.random.default_rng(3)
    ids, labels = rng.integers(0, 65536, (37, 8)), rng.integers(-100, 60000, (37, 8))
    rows = [(i, ids[i].tolist(), labels[i].tolist()) for i in range(37)]
    df = spark.createDataFrame(rows, "row long, input_ids array<int>, labels array<int>").repartition(5)
    for _ in range(2):  # a second write replaces the first
        sh.write_sft_shards(df, str(tmp_path), "val", 8)
    meta = json.load(open(tmp_path / "val_metadata.json"))
    assert meta["num_examples"] == 37 and "parts" not in meta
    assert (np.memmap(tmp_path / meta["input_ids_path"], "<u2", mode="r", shape=(37, 8)) == ids).all()
    assert (np.memmap(tmp_path / meta["labels_path"], "<i4", mode="r", shape=(37, 8)) == labels).all()
    for bad in (df.where("row <> 5"), df.union(df.limit(1)), df.where("row < 0")):
        with pytest.raises(Exception):
            sh.write_sft_shards(bad, str(tmp_path), "bad", 8)
    assert not os.path.exists(tmp_path / "bad_metadata.json")


def test_a_shorter_write_leaves_no_stale_shards_and_append_is_refused(spark, tmp_path):
    def pieces(n):
        return spark.createDataFrame([(i, 0, [i] * 4) for i in range(n)], "shard long, shard_pos long, tokens array<int>")

    sh.write_token_shards(pieces(5), str(tmp_path), "train")
    sh.write_token_shards(pieces(2), str(tmp_path), "train")
    assert sorted(p.name for p in tmp_path.glob("*.bin")) == ["train_00000.bin", "train_00001.bin"]
    with pytest.raises(Exception, match="overwrite"):
        pieces(1).write.format("token_shards").option("prefix", "train").mode("append").save(str(tmp_path))
    assert len(json.load(open(tmp_path / "train_manifest.json"))) == 2


def test_metric_logs_take_a_file_per_task_not_per_run(spark):
    names = [f"run_{i}" for i in range(40)] + ["a/b:c", None]
    rows = [(r, "train", "2025-01-01T00:00:00", i, float(i)) for i, r in enumerate(names) for _ in range(2)]
    log = spark.createDataFrame(rows, "run_id string, event string, timestamp string, step long, loss double").repartition(3)
    log = log.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in METRIC_SCHEMA.fields if f.name not in log.columns])
    d = os.path.join(_tmp(), "logs")
    write_metrics(log, d, mode="overwrite")
    assert len([f for _, _, fs in os.walk(d) for f in fs if f.endswith(".json")]) <= 3
    os.makedirs(os.path.join(d, "run_id=old"))  # a folder per run, as written before, is still read
    with open(os.path.join(d, "run_id=old", "part-0.json"), "w") as fh:
        fh.write(json.dumps({"event": "train", "timestamp": "2025-01-01T00:00:00", "step": 7, "loss": 7.0}) + "\n")
    want = sorted([(r or "__HIVE_DEFAULT_PARTITION__", i) for i, r in enumerate(names)] * 2 + [("old", 7)])
    for back in (read_metrics(spark, d), read_growing_metrics(spark, d)):
        assert sorted((r.run_id, r.step) for r in back.select("run_id", "step").collect()) == want


def test_small_token_shards_share_tasks(spark):
    out = _tmp()
    toks = list(range(5000))
    pieces = [(i // 100, i % 100, toks[i:i + 50]) for i in range(0, 5000, 50)]
    df = spark.createDataFrame(pieces, "shard long, shard_pos long, tokens array<int>")
    sh.write_token_shards(df, out, "train", shards=50, tokens=5000)
    assert [(m["path"], m["num_tokens"]) for m in json.load(open(os.path.join(out, "train_manifest.json")))] == [(f"train_{i:05d}.bin", 100) for i in range(50)]
    back = sh.read_token_shards(spark, out, "train", chunk_tokens=64)
    rows = back.orderBy("shard", "start").collect()
    assert [t for r in rows for t in r.tokens] == toks and len(rows) == 100
    assert back.rdd.getNumPartitions() == 1
    assert sh.read_token_shards(spark, out, "train", chunk_tokens=64, partition_tokens=300).rdd.getNumPartitions() == 17
