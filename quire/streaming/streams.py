"""Structured Streaming operators.

* ``stream_corpus``: documents arriving as files are cleaned and tokenized without
  landing first; the tokenized rows go to a parquet sink (exactly-once with the
  checkpoint). Mixing stays a batch job over the landed table, because the stream
  order depends on totals.
* ``stream_metrics``: follow metric logs, as files that grow in place
  (``sources.growing``) or as new files that appear.
* ``stream_run_latest``: latest step, loss and status per run, as a streaming
  aggregation in update mode: a micro-batch writes only the runs it touched, as a version
  of the table that a repeated batch replaces.

Every query keeps its checkpoint in the session's shared checkpoint folder, so a
restart resumes where it stopped without duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.sources.corpus import clean_corpus
from quire.sources.metrics import LINE_SCHEMA, normalize_log, run_key


def read_corpus_stream(spark: SparkSession, path: str, schema, source_col: str = "source", id_col: str = "doc_id",
                       text_col: str = "text", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.parquet(path)
    return raw.select(F.col(source_col).alias("source"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def stream_corpus(docs: DataFrame, tokenizer, out_path: str, checkpoint: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Clean + tokenize a document stream into ``out_path`` (parquet)."""
    tok = clean_corpus(docs).withColumn("ids", tokenizer.encode("text")).withColumn("n_tokens", F.size("ids").cast("long"))
    tok = tok.where(F.col("n_tokens") > 0).select("source", "doc_id", "n_tokens", "ids")
    w = tok.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_metrics_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(LINE_SCHEMA)
        .option("allowNonNumericNumbers", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.json*")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.json(path)
    return normalize_log(df.withColumn("run_id", run_key("run_id", F.col("_metadata.file_path"))))


def stream_metrics(log_stream: DataFrame, out_path: str, checkpoint: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Land the followed log rows as parquet, partitioned by event."""
    w = (
        log_stream.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
        .partitionBy("event").outputMode("append")
    )
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_latest(log: DataFrame) -> DataFrame:
    """Per run: latest train step and its loss, latest eval, status (works on a batch or
    a streaming log)."""
    train = F.col("event") == "train"
    return log.groupBy("run_id").agg(
        F.max(F.when(train, F.col("step"))).alias("last_step"),
        F.max_by(F.when(train, F.col("loss")), F.when(train, F.col("step"))).alias("last_loss"),
        F.max_by(F.when(F.col("event") == "eval", F.col("val_loss")), F.when(F.col("event") == "eval", F.col("step"))).alias("last_val_loss"),
        F.max((F.col("event") == "run_finished").cast("int")).alias("finished"),
        F.count(F.lit(1)).alias("events"),
    )


def stream_run_latest(log_stream: DataFrame, out_path: str, checkpoint: str, trigger_available_now: bool = True) -> StreamingQuery:
    """Streaming ``run_latest``. The runs' state is kept by key; a micro-batch hands on only the
    runs it touched, which are written as the version ``batch_id`` of the table at
    ``out_path``. A batch that runs again replaces its own version."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = run_latest(log_stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="10 seconds")
    return w.start()


LATEST = "batch_id long, run_id string, last_step long, last_loss double, last_val_loss double, finished int, events long"


def read_run_latest(spark: SparkSession, out_path: str) -> DataFrame:
    """The present row of every run: its highest version."""
    versions = spark.read.schema(LATEST).parquet(out_path)
    columns = [c for c in versions.columns if c not in ("run_id", "batch_id")]
    last = versions.groupBy("run_id").agg(F.max_by(F.struct(*columns), "batch_id").alias("r"))
    return last.select("run_id", *[F.col(f"r.{c}").alias(c) for c in columns])
