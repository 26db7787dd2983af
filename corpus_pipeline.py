"""The training-corpus pipeline over ``documents``: quality filter, toxicity filter,
SimHash near-dedup, substring dedup, packing. Each stage is one operator applied to all
that the stage before it kept; its result is written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.batches import prepared, table, without_rows
from quire.llm.cost_packing import pack_documents
from quire.llm.phrase_automata import without_repeats
from quire.llm.simhash_pivots import keep_one_per_group
from quire.llm.site_bayes import classify
from quire.llm.toxicity_gbt import score_toxicity
from quire.plans.materialize import checkpointed

WINDOW, SHINGLE, MAX_BITS, SEQ_LEN = 50, 3, 3, 1024


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps."""
    found = classify(docs, table(spark, sf_dir, "labels"))
    return without_rows(docs, found.where(~F.col("kept")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    found = score_toxicity(docs, table(spark, sf_dir, "labels"))
    return without_rows(docs, found.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    prepared(spark)
    return keep_one_per_group(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand in one with a smaller id; a text
    that lost words is its other words joined by one space."""
    prepared(spark)
    cut = without_repeats(docs, window=WINDOW)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else cut


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    prepared(spark)
    pieces = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), seq_len=SEQ_LEN, separator=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Classifiers, fingerprints and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
