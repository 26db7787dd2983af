"""Evaluation result files (``results_*.json``) and the comparison table sinks."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.paths import plain_path

RESULTS_SCHEMA = T.StructType([
    T.StructField("config_general", T.StructType([T.StructField("model_name", T.StringType())])),
    T.StructField("results", T.MapType(T.StringType(), T.StructType([
        T.StructField("acc", T.DoubleType()), T.StructField("acc_stderr", T.DoubleType()),
    ]))),
    T.StructField("versions", T.MapType(T.StringType(), T.LongType())),
])


def read_eval_results(spark: SparkSession, root: str) -> DataFrame:
    """Every ``results_*.json`` below ``root`` (recursively) → one row per (file, task):
    ``model, file, task, acc, acc_stderr, version``. ``file`` is the path relative to
    ``root`` so that path order decides which file wins when merging."""
    raw = (
        spark.read.schema(RESULTS_SCHEMA)
        .option("multiLine", "true")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "results_*.json")
        .json(root)
        .withColumn("path", F.col("_metadata.file_path"))
    )
    base = plain_path(spark, root)
    whole = F.url_decode(F.replace(F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("+"), F.lit("%2B")))
    rel = F.ltrim(F.substring(whole, len(base) + 1, 1 << 30), F.lit("/"))
    rows = raw.select(
        F.col("config_general.model_name").alias("model"), rel.alias("file"),
        F.explode("results").alias("task", "r"), "versions",
    )
    return rows.select("model", "file", "task", F.col("r.acc").alias("acc"), F.col("r.acc_stderr").alias("acc_stderr"),
                       F.col("versions")[F.col("task")].alias("version"))


def _write_group(rows):
    """Executor side: write one results file from its (already grouped) rows."""
    for r in rows:
        os.makedirs(os.path.dirname(r["abs_path"]), exist_ok=True)
        with open(r["abs_path"], "w", encoding="utf-8") as fh:
            fh.write(r["doc"])


def write_eval_results(rows: DataFrame, root: str) -> None:
    """Rows ``(model, file, task, acc, acc_stderr, version)`` → one JSON file per
    ``file`` below the POSIX folder ``root``. Files are assembled with ``groupBy`` (a
    file's content is bounded by its task count) and written by executors."""
    doc = F.to_json(F.struct(
        F.struct(F.first("model").alias("model_name")).alias("config_general"),
        F.map_from_entries(F.collect_list(F.struct("task", F.struct("acc", "acc_stderr")))).alias("results"),
        F.map_from_entries(F.collect_list(F.struct("task", F.struct("file")))).alias("config_tasks"),
        F.map_from_entries(F.collect_list(F.struct("task", F.struct("version")))).alias("summary_tasks"),
        F.map_from_entries(F.collect_list(F.struct("task", F.col("version").cast("long")))).alias("versions"),
    ))
    files = rows.groupBy("file").agg(doc.alias("doc")).withColumn("abs_path", F.concat(F.lit(root.rstrip("/") + "/"), F.col("file")))
    files.select("abs_path", "doc").foreachPartition(_write_group)


def write_comparison(table: DataFrame, out_dir: str, columns: list[str]) -> None:
    """CSV (header, quoted) and Markdown with a fixed column order. The table is one
    row per model, so the Markdown text is assembled on the driver from a bounded
    result."""
    table.select(*columns).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{out_dir}/comparison_table_csv")
    rows = table.select(*columns).orderBy(columns[0]).collect()  # one row per model
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    for r in rows:
        lines.append("| " + " | ".join("" if v is None else str(v) for v in r) + " |")
    path = out_dir.split("file:", 1)[-1]
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "comparison_table.md"), "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")

