"""Chat data scans: single source or a weighted mix with row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import ChatConfig, ChatSourceConfig
from quire.functions.text import all_of
from quire.sources.paths import dataset_path


def scan_chat(spark: SparkSession, source: ChatSourceConfig, fmt: str = "parquet") -> DataFrame:
    """Raw chat rows of one source: its ``path``, revision, sub-configuration and split,
    which must exist when they are named."""
    path = dataset_path(spark, source.path, None, source.config_name, source.split, source.revision, f"chat source {source.source_name!r}")
    return spark.read.format(fmt).load(path)


def row_filters(df: DataFrame, filters: dict[str, str] | None) -> DataFrame:
    """Equality filters on data fields (pushed to the scan by Catalyst)."""
    if not filters:
        return df
    return df.where(all_of([F.col(k) == F.lit(v) for k, v in filters.items()]))


def scan_chat_mix(frames: dict[str, DataFrame], config: ChatConfig) -> DataFrame:
    """Union of the configured chat sources, each with its row filters applied and a
    ``source`` column. ``frames`` maps source name → raw rows of that source."""
    parts = []
    for s in config.sources:
        parts.append(row_filters(frames[s.source_name], s.row_filters).withColumn("source", F.lit(s.source_name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
