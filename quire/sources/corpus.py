"""Corpus and chat scans.

Each configured source is read with ``spark.read`` and projected to its own text
field, so Catalyst prunes every other column at the scan. Sources are unioned by
name; nothing is materialized.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import DataMixConfig, SourceConfig
from quire.functions.text import has_content, py_strip
from quire.sources.paths import dataset_path

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_source(spark: SparkSession, source: SourceConfig, id_field: str | None = None) -> DataFrame:
    """``source, doc_id, text`` for one configured source: its path, revision, folder,
    sub-configuration and split (see ``dataset_path``). Without ``id_field`` a row's id is
    a hash of its file and its place in it, so equal texts keep distinct ids; only
    Parquet tells rows' places, other formats need an id field."""
    if not source.path and not source.data_dir:
        raise ValueError(f"source {source.name!r} has no path")
    path, data_dir = (source.path, source.data_dir) if source.path else (source.data_dir, None)
    path = dataset_path(spark, path, data_dir, source.config_name, source.split, source.revision, f"source {source.name!r}")
    df = spark.read.format(source.format).load(path)
    if id_field:
        df = df.withColumn("__id", F.col(id_field).cast("long"))
    elif source.format == "parquet":
        df = df.withColumn("__id", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    else:
        raise ValueError(f"source {source.name!r}: format {source.format!r} needs an id field")
    for k, v in (source.row_filters or {}).items():
        df = df.where(F.col(k) == F.lit(v))  # pushed to the scan
    field = source.text_field or "text"
    dtype = dict(df.dtypes).get(field)
    if dtype is None:
        raise ValueError(f"source {source.name!r}: text field {field!r} not found")
    # Only string values count as documents (non-strings are skipped, not cast).
    text = F.col(field) if dtype == "string" else F.lit(None).cast("string")
    return df.select(F.lit(source.name).alias("source"), F.col("__id").alias("doc_id"), text.alias("text"))


def scan_corpus(spark: SparkSession, mix: DataMixConfig, id_field: str | None = None) -> DataFrame:
    """Union of all configured sources (``source, doc_id, text``)."""
    frames = [scan_source(spark, s, id_field) for s in mix.sources]
    return reduce(lambda a, b: a.unionByName(b), frames)


def corpus_from_table(
    df: DataFrame,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
    sources: Sequence[str] | None = None,
) -> DataFrame:
    """A table holding several sources in one column (the driver's ``documents``)."""
    out = df.select(F.col(source_col).alias("source"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if sources is not None:
        out = out.where(F.col("source").isin(list(sources)))
    return out


def chain_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate sources (by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def clean_corpus(docs: DataFrame) -> DataFrame:
    """Keep string texts, stripped, non-empty (``text`` replaced by the stripped text).

    The blank test runs on the raw text (a regex find that stops at the first
    non-whitespace character), so the strip itself is evaluated once per row."""
    return docs.where(has_content("text")).withColumn("text", py_strip("text"))


def tokenized_corpus(docs: DataFrame, tokenizer, template: bool = True, with_ids: bool = False) -> DataFrame:
    """Cleaned documents with ``n_tokens`` (and ``ids`` when asked). Documents with no
    tokens are dropped (``drop_untokenized``)."""
    out = clean_corpus(docs)
    if with_ids:
        out = out.withColumn("ids", tokenizer.encode("text", template)).withColumn("n_tokens", F.size("ids").cast("long"))
    else:
        out = out.withColumn("n_tokens", tokenizer.count("text", template))
    return out.where(F.col("n_tokens") > 0)
