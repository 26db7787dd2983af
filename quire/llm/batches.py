"""Small helpers shared by the operators of this package: reading text columns out of
Arrow batches, the ASCII-only word rule, and folds of document ids."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import ensure_checkpoint_dir, ship_package


def prepared(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors and settle the checkpoint folder."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so extra columns (whatever their names)
    never reach it and the scan is pruned; ids as long, a null text as it is."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold(id_col: str | Column, folds: int) -> Column:
    """``crc32(id as text) mod folds``; a null id falls in fold 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(folds), F.lit(0)).cast("int")


def sampled(order: Column, most: int, rows: int, parts: int = 1 << 20) -> Column:
    """Condition that lets through somewhat more than ``most`` of ``rows`` rows, those of
    the lowest hash ``order``, so that an ``orderBy(order).limit(most)`` after it moves no
    more than that to the driver however many tasks there are."""
    share = 1.0 if rows <= 0 else min(1.0, (most + 10 * most**0.5 + 100) / rows)
    return F.lit(True) if share >= 1 else order < F.lit(int((share - 0.5) * 2**64))


def raw_texts(column) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def lower_words(raw: bytes) -> list[bytes]:
    """Maximal runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lowered: ``bytes.lower`` and
    ``bytes.split`` touch exactly the ASCII letters and those six ASCII spaces."""
    return raw.lower().split()


def without_rows(df: DataFrame, rejected: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` less the rows whose id and text hash are in ``rejected(doc_id, text_key)``."""
    gone = rejected.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__key"))
    return df.join(gone, same, "left_anti")


def pieces_of(batch, rows: int = 1024):
    """Cut a record batch so that no step holds more than ``rows`` texts at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def blocks_of(batch, rows: int = 2048, size: int = 16 << 20, column: int = 1):
    """Cut a record batch in blocks of at most ``rows`` rows and about ``size`` bytes of text (one
    row at least)."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype("i8")
    ends = np.cumsum(lengths)
    i = 0
    while i < batch.num_rows:
        most = int(np.searchsorted(ends, (ends[i - 1] if i else 0) + size, "right"))
        j = min(max(i + 1, most), i + rows, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_free_env() -> None:
    """Single-threaded native libraries inside tasks (Spark owns the parallelism)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
