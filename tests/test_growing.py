"""Logs that grow while they are followed, and the table of runs kept by key."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from quire.sources.growing import Files, Range, read_growing_metrics, read_growing_metrics_stream
from quire.sources.metrics import read_metrics
from quire.streaming import streams as st
from tests.conftest import ROOT


def line(step, loss=1.0, event="train"):
    return json.dumps({"event": event, "timestamp": "2025-01-01T00:00:00", "step": step, "loss": loss}) + "\n"


def append(path, text):
    with open(path, "a") as f:
        f.write(text)


def test_lines_appended_to_one_file_arrive_once(spark, tmp_path):
    logs, out, ck = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    logs.mkdir()
    a, b = logs / "run_a.jsonl", logs / "run_b.jsonl"

    def drain(split=16 << 20):  # each call restarts the query from its checkpoint
        st.stream_metrics(read_growing_metrics_stream(spark, str(logs), split), out, ck).awaitTermination()
        return sorted((r.run_id, r.step) for r in spark.read.parquet(out).select("run_id", "step").collect())

    append(a, line(1) + line(2) + line(3)[:20])  # the last line is unfinished
    assert drain() == [("run_a", 1), ("run_a", 2)]
    assert drain() == [("run_a", 1), ("run_a", 2)]
    append(a, line(3)[20:])
    append(b, line(1))
    assert drain() == [("run_a", 1), ("run_a", 2), ("run_a", 3), ("run_b", 1)]
    append(a, "".join(line(s) for s in range(4, 500)) + "\n\n")
    got = drain(split=1000)
    assert got == sorted([("run_a", s) for s in range(1, 500)] + [("run_b", 1)])
    whole = lambda df: sorted(str(r) for r in df.collect())
    assert whole(read_growing_metrics(spark, str(logs))) == whole(read_metrics(spark, str(logs)))
    assert whole(spark.read.parquet(out).select("run_id", "event", "step", "loss")) == whole(read_metrics(spark, str(logs)).select("run_id", "event", "step", "loss"))

    b.write_text(line(7, 2.0)[:-1].replace("2025", "2026") + "\n")  # replaced by a file of the same length
    assert [x for x in drain() if x[0] == "run_b"] == [("run_b", 1), ("run_b", 7)]
    a.write_text(line(9))  # truncated
    assert [x for x in drain() if x[0] == "run_a"].count(("run_a", 9)) == 2


def test_ranges_share_out_lines(tmp_path):
    text = b"".join(b"%d%s\n" % (i, b"x" * (i * 37 % 90)) for i in range(300)) + b"\r\n  \nlast"
    (tmp_path / "a.jsonl").write_bytes(text)
    want = [x.rstrip("\r") for x in text.decode().split("\n") if x.strip()]
    for split in (1, 7, 100, 10_000):
        files = Files({"path": str(tmp_path), "splitBytes": str(split)})
        parts = files.ranges(str(tmp_path / "a.jsonl"), 0, len(text))
        got = [(p, v) for part in parts for b in files.lines(part) for p, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        assert [v for _, v in got] == want
        assert all(text[p:].startswith(v.encode()) for p, v in got)
    one = files.lines(Range(str(tmp_path / "a.jsonl"), 5, 5, 6))
    assert [b.num_rows for b in one] == [1]


def test_run_table_writes_only_touched_runs_and_survives_a_repeated_batch(spark, tmp_path):
    logs, out, ck = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    logs.mkdir()

    def drain():
        st.stream_run_latest(read_growing_metrics_stream(spark, str(logs)), out, ck).awaitTermination()
        return {r.run_id: (r.last_step, r.last_loss, r.events, r.finished) for r in st.read_run_latest(spark, out).collect()}

    for run in "abc":
        append(logs / f"{run}.jsonl", line(1, 5.0) + line(2, 4.0))
    first = drain()
    assert first == {run: (2, 4.0, 2, 0) for run in "abc"}
    append(logs / "b.jsonl", line(3, 3.5) + line(3, None, "run_finished"))
    assert drain() == first | {"b": (3, 3.5, 4, 1)}
    rows = lambda: {r.batch_id: r.n for r in spark.read.schema(st.LATEST).parquet(out).groupBy("batch_id").agg(F.count("*").alias("n")).collect()}
    assert rows() == {0: 3, 1: 1}  # the second batch wrote the run it touched
    # The last batch's commit is lost after its rows were written: it runs again on restart.
    for f in os.listdir(f"{ck}/commits"):
        if f.strip(".").split(".")[0] == "1":
            os.unlink(f"{ck}/commits/{f}")
    assert drain() == first | {"b": (3, 3.5, 4, 1)}
    assert rows() == {0: 3, 1: 1}


def test_queries_without_the_optional_packages():
    code = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] in ('public_tokenizers', 'xxhash', 'ahocorasick'):
            raise ImportError(name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
assert len(e.queries()) > 90 and not any(q.startswith('op') for q in e.queries()), len(e.queries())
assert 'pipeline' not in e.oracle_sql() and 'op7_license_diagonals' not in e.oracle_sql()
print('fine')
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "fine" in done.stdout, done.stderr[-2000:]
