"""Streaming workloads: each drains the stream (available-now trigger) into the
shared scratch folder and returns the landed result as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.tokenizers import ByteTokenizer
from quire.session import posix_scratch, scratch_path
from quire.sources.corpus import read_table
from quire.sources.growing import read_growing_metrics_stream
from quire.sources.metrics import write_metrics
from quire.streaming import streams as st
from quire.workloads import runs as wr
from quire.workloads import vocab as wv


def q_stream_corpus(spark, sf):
    schema = read_table(spark, sf, "documents").schema
    docs = st.read_corpus_stream(spark, f"{sf.rstrip('/')}/documents*.parquet", schema)
    out, ck = scratch_path(spark, "stream-corpus"), scratch_path(spark, "stream-corpus-ck")
    q = st.stream_corpus(docs, ByteTokenizer(), out, ck)
    q.awaitTermination()
    landed = spark.read.parquet(out)
    return landed.select("doc_id", "n_tokens", F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def _log_files(spark, sf, path: str | None = None) -> str:
    path = path or scratch_path(spark, "stream-logs")
    write_metrics(wr.log(spark, sf), path, mode="overwrite")
    return path


def q_stream_metrics(spark, sf):
    src = _log_files(spark, sf)
    out, ck = scratch_path(spark, "stream-metrics"), scratch_path(spark, "stream-metrics-ck")
    q = st.stream_metrics(st.read_metrics_stream(spark, src), out, ck)
    q.awaitTermination()
    return _by_event(spark.read.parquet(out))


def _by_event(log):
    return log.groupBy("run_id", "event").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.isnan("grad_norm"), 1).otherwise(0)).cast("long").alias("nan_norms"),
        F.max("step").alias("max_step"),
    )


def q_stream_growing_metrics(spark, sf):
    """The logs followed by bytes instead of by files: two drains, the second over what came
    since the first (the logs of later runs)."""
    path = posix_scratch(spark, "growing-logs")
    out, ck = scratch_path(spark, "growing-metrics"), scratch_path(spark, "growing-metrics-ck")
    late = F.pmod(F.xxhash64("run_id"), F.lit(2)) == 1
    for part in (~late, late):
        write_metrics(wr.log(spark, sf).where(part), path, mode="append")
        st.stream_metrics(read_growing_metrics_stream(spark, path), out, ck).awaitTermination()
    return _by_event(spark.read.parquet(out))


def q_stream_run_latest(spark, sf):
    src = _log_files(spark, sf)
    out, ck = scratch_path(spark, "run-latest"), scratch_path(spark, "run-latest-ck")
    q = st.stream_run_latest(st.read_metrics_stream(spark, src), out, ck)
    q.awaitTermination()
    r = st.read_run_latest(spark, out)
    return r.select("run_id", "last_step", "last_loss", "last_val_loss", F.col("finished").cast("long").alias("finished"), "events")


QUERIES = {
    "stream_corpus": q_stream_corpus,
    "stream_metrics": q_stream_metrics,
    "stream_growing_metrics": q_stream_growing_metrics,
    "stream_run_latest": q_stream_run_latest,
}

SQL = {
    "stream_corpus": wv.SQL["encode_corpus"],
    "stream_metrics": wr.SQL["read_metrics"],
    "stream_growing_metrics": wr.SQL["read_metrics"],
    "stream_run_latest": wr.LOG + """SELECT run_id,
          max(step) FILTER (WHERE event = 'train') AS last_step,
          arg_max(value, step) FILTER (WHERE event = 'train') AS last_loss,
          arg_max(value, step) FILTER (WHERE event = 'eval') AS last_val_loss,
          CAST(max(CASE WHEN event = 'run_finished' THEN 1 ELSE 0 END) AS BIGINT) AS finished,
          CAST(count(*) AS BIGINT) AS events
        FROM lg GROUP BY run_id""",
}
