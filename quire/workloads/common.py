"""Shared settings for the workloads over the driver's tables.

The driver tables stand in for the original inputs (see FIXTURES.md §B):
``documents`` is the multi-source corpus (``source`` = mixture source),
``conversations`` the chat data, ``labels`` the row filters, ``events`` the metric
log and ``documents`` x ``labels`` the scored benchmark rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.config import DataMixConfig, SourceConfig
from quire.functions.text import PY_WHITESPACE
from quire.sources.corpus import read_table

SEED = 42

# Mixture over all sources of the table. One source is dominant (~30% of every split
# with twenty sources) so the plan is exercised with a hot key.
DOMINANT = "src0"
DOMINANT_WEIGHT = 8.0
TRAIN_FRACTION = 0.12
VAL_FRACTION = 0.01
SHARD_SIZE = 20_000
VAL_SHARD_SIZE = 20_000


def table_mixture(spark: SparkSession, sf: str) -> DataMixConfig:
    """The mixture over every source that ``documents`` has (a configuration-sized list)."""
    docs = read_table(spark, sf, "documents").where(F.col("source").isNotNull())
    names = sorted(r.source for r in docs.select("source").distinct().collect())
    sources = [SourceConfig(name=n, weight=DOMINANT_WEIGHT if n == DOMINANT else 1.0) for n in names]
    return DataMixConfig(sources=sources, shard_size_tokens=SHARD_SIZE, val_tokens=VAL_SHARD_SIZE)


def shard_sizes() -> dict[str, int]:
    return {"train": SHARD_SIZE, "val": VAL_SHARD_SIZE}


# ---------------------------------------------------------------- SQL helpers


def sql_ws() -> str:
    """The Python whitespace set as a SQL expression (``chr`` concatenation)."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def sql_strip(expr: str) -> str:
    return f"trim({expr}, {sql_ws()})"


def sql_double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


SQL_SOURCES = f"""(
    SELECT source, CAST(row_number() OVER (ORDER BY source) - 1 AS INTEGER) AS source_index, weight, weight / sum(weight) OVER () AS share
    FROM (SELECT DISTINCT source, CASE WHEN source = '{DOMINANT}' THEN {sql_double(DOMINANT_WEIGHT)} ELSE {sql_double(1.0)} END AS weight
          FROM documents WHERE source IS NOT NULL)) AS t"""


def sql_allocate(table: str, total_expr: str, out: str) -> str:
    """SQL for ``allocate_targets``: ``table`` has ``source, share`` and ``total_expr``."""
    return f"""
    SELECT * EXCLUDE (__raw, __base, __frac, __n, __rem, __rank),
           CAST(__base + (__rem // __n) + CASE WHEN __rank < __rem % __n THEN 1 ELSE 0 END AS BIGINT) AS {out}
    FROM (
      SELECT *, greatest(CAST({total_expr} AS BIGINT) - sum(__base) OVER (), 0) AS __rem,
             count(*) OVER () AS __n,
             row_number() OVER (ORDER BY __frac DESC, source DESC) - 1 AS __rank
      FROM (
        SELECT *, CAST(floor(__raw) AS BIGINT) AS __base, __raw - floor(__raw) AS __frac
        FROM (SELECT *, CAST({total_expr} AS DOUBLE) * share AS __raw FROM {table})
      )
    )"""


def sql_byte_docs() -> str:
    """Cleaned documents with byte-tokenizer counts."""
    return f"""
    SELECT source, doc_id, CAST(strlen({sql_strip('text')}) + 2 AS BIGINT) AS n_tokens
    FROM documents
    WHERE text IS NOT NULL AND {sql_strip('text')} <> '' AND source IS NOT NULL"""
