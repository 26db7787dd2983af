"""The queries of this package over the driver's tables: one per operator, each applied
with its production parameters to the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.batches import table
from quire.llm.bit_sliced import top_k
from quire.llm.brown_classes import score_documents
from quire.llm.bpe_transducer import encode_documents
from quire.llm.cost_packing import pack_documents
from quire.llm.l2_negatives import mine_negatives
from quire.llm.license_diagonals import scan_licenses
from quire.llm.line_runs import dedup_lines
from quire.llm.oracles import licenses_sql, lines_sql, near_vectors_sql, negatives_sql, substrings_sql, top_k_sql
from quire.llm.phrase_automata import dedup_substrings
from quire.llm.polar_whitening import whiten
from quire.llm.pq_neardup import near_duplicates as pq_near_duplicates
from quire.llm.simhash_pivots import near_duplicates
from quire.llm.site_bayes import classify
from quire.llm.toxicity_gbt import score_toxicity


def op1_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op2_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, scale=256.0, every=50)


def op3_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("text_key")


def op4_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.drop("text_key")


def op7_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op8_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), seq_len=1024, separator=0
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_pq_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3).drop("kept")


def op12_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), scale=1024.0, offset=100_000, components=8)


def op13_l2_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(rows.withColumn("label", moved), scale=256.0, every=100, positives=5, negatives=5, least=80)


QUERIES = {
    "op1_brown_classes": op1_brown_classes,
    "op2_bit_sliced": op2_bit_sliced,
    "op3_site_bayes": op3_site_bayes,
    "op4_simhash_pivots": op4_simhash_pivots,
    "op5_bpe_transducer": op5_bpe_transducer,
    "op6_toxicity_gbt": op6_toxicity_gbt,
    "op7_license_diagonals": op7_license_diagonals,
    "op8_cost_packing": op8_cost_packing,
    "op9_phrase_automata": op9_phrase_automata,
    "op10_pq_neardup": op10_pq_neardup,
    "op11_line_runs": op11_line_runs,
    "op12_polar_whitening": op12_polar_whitening,
    "op13_l2_negatives": op13_l2_negatives,
}

SQL: dict[str, str] = {
    "op2_bit_sliced": top_k_sql(),
    "op7_license_diagonals": licenses_sql(),
    "op9_phrase_automata": substrings_sql(),
    "op10_pq_neardup": near_vectors_sql(),
    "op11_line_runs": lines_sql(),
    "op13_l2_negatives": negatives_sql(),
}
