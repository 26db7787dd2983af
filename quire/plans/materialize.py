"""Materialization points.

A two-pass plan (prefix sums, a budget check) reads its input twice; without a
materialization point Spark recomputes the whole upstream lineage — scan, clean and,
worst of all, tokenize — for every pass. ``checkpointed`` cuts the lineage explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a parquet table below the session's shared checkpoint folder
    and read it back: one job (an eager ``checkpoint()`` would compute its input twice
    or need a cache), lineage cut, survives lost executors, and later stages get file
    statistics for AQE."""
    from quire.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, f"table-{name}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
