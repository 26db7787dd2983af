"""Vocabulary and tokenization workloads over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import PY_WHITESPACE
from quire.functions.tokenizers import ByteTokenizer, WhitespaceTokenizer
from quire.operators import vocab as vb
from quire.operators.bpe_encode import BPETokenizer, encode_documents
from quire.operators.bpe_train import train_bpe
from quire.plans.materialize import checkpointed
from quire.sources.corpus import clean_corpus, corpus_from_table, read_table, tokenized_corpus
from quire.workloads.common import SEED, SQL_SOURCES, sql_double, sql_strip, table_mixture

SAMPLE_FRACTION = 0.5
BPE_VOCAB = 49_152  # the production vocabulary; a small table has fewer pairs that occur twice
ENCODE_VOCAB = 2_048
MIN_FREQUENCY = 2


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean_corpus(corpus_from_table(read_table(spark, sf, "documents")))


def sample(spark, sf, ranked: bool = True) -> DataFrame:
    return vb.sample_documents_scaled(cleaned(spark, sf), spark, table_mixture(spark, sf), SAMPLE_FRACTION, SEED, ranked)


def q_sample_documents(spark, sf):
    return sample(spark, sf).select("source", "doc_id", "sample_rank")


def q_limit_per_source(spark, sf):
    s = sample(spark, sf)
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.max("sample_rank").alias("last_rank"))


def q_pretokenize(spark, sf):
    d = cleaned(spark, sf).withColumn("pieces", vb.pretokenize("text"))
    return d.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"),
        F.md5(F.array_join("pieces", "\u0001")).alias("pieces_md5"),
        (F.array_join("pieces", "") == F.col("text")).alias("lossless"),
    )


def q_word_counts(spark, sf):
    d = cleaned(spark, sf).select(WhitespaceTokenizer().pieces("text").alias("p"))
    return vb.word_counts(d, "p")


def trained(docs: DataFrame, vocab_size: int) -> vb.BPEModel:
    words = vb.word_counts(docs.select(vb.pretokenize("text").alias("p")), "p")
    return train_bpe(docs.sparkSession, checkpointed(words, "vocab-words"), vocab_size, MIN_FREQUENCY)


def q_train_bpe(spark, sf):
    _, merges = vb.model_tables(spark, trained(sample(spark, sf, ranked=False), BPE_VOCAB))
    return merges


def q_encode_bpe(spark, sf):
    """A vocabulary learned from the sample, and all documents encoded with it through a
    dictionary of their pieces, then decoded."""
    tokenizer = BPETokenizer(trained(sample(spark, sf, ranked=False), ENCODE_VOCAB))
    coded = encode_documents(cleaned(spark, sf), tokenizer)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("ids_md5"),
        F.md5(tokenizer.decode("ids")).alias("text_md5"),
    )


def q_encode_corpus(spark, sf):
    t = tokenized_corpus(cleaned(spark, sf), ByteTokenizer(), with_ids=True)
    return t.select("doc_id", "n_tokens", F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def q_encode_plain(spark, sf):
    t = cleaned(spark, sf).withColumn("ids", ByteTokenizer().encode("text", template=False))
    return t.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.md5(F.array_join("ids", ",")).alias("ids_md5"))


def q_decode_tokens(spark, sf):
    bt = ByteTokenizer()
    t = cleaned(spark, sf).withColumn("back", bt.decode(bt.encode("text")))
    return t.select("doc_id", F.md5("back").alias("text_md5"))


QUERIES = {
    "sample_documents": q_sample_documents,
    "limit_per_source": q_limit_per_source,
    "pretokenize": q_pretokenize,
    "word_counts": q_word_counts,
    "train_bpe": q_train_bpe,
    "encode_bpe": q_encode_bpe,
    "encode_corpus": q_encode_corpus,
    "encode_plain": q_encode_plain,
    "decode_tokens": q_decode_tokens,
}

# ---------------------------------------------------------------- SQL side


def _sql():
    s = sql_strip
    ws_class = "'[' || " + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + " || ']+'"
    clean = f"SELECT source, doc_id, {s('text')} AS text FROM documents WHERE text IS NOT NULL AND {s('text')} <> ''"
    sample_ctes = f"""
WITH cd AS ({clean}),
n AS (SELECT source, count(*) AS n FROM cd GROUP BY source),
src AS (SELECT source, share FROM {SQL_SOURCES}),
q AS (
  SELECT s.source, greatest(CAST(floor(floor(CAST(sum(coalesce(n.n, 0)) OVER () AS DOUBLE) * {sql_double(SAMPLE_FRACTION)}) * s.share) AS BIGINT), 1) AS quota
  FROM src s LEFT JOIN n USING (source)),
rk AS (
  SELECT cd.source, cd.doc_id,
         CAST(row_number() OVER (PARTITION BY cd.source ORDER BY md5('{SEED}:' || cd.source || ':' || CAST(cd.doc_id AS VARCHAR)), cd.doc_id) AS BIGINT) AS sample_rank
  FROM cd),
smp AS (SELECT rk.* FROM rk JOIN q USING (source) WHERE rk.sample_rank <= q.quota)
"""
    # The pattern has no lookahead in DuckDB: a mark (U+F0000) goes before the last blank of a
    # run that a word follows, which ends the run there.
    blank = "\\t-\\r \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
    marked = f"regexp_replace(text, '([{blank}])([{blank}][^{blank}])', '\\1' || chr(983040) || '\\2', 'g')"
    kinds = f"''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{blank}\\p{{L}}\\p{{N}}\\x{{f0000}}]+|[{blank}]+"
    byte_list = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST(('0x' || x) AS INTEGER) + 4)"
    return {
        "sample_documents": sample_ctes + "SELECT source, doc_id, sample_rank FROM smp",
        "limit_per_source": sample_ctes + "SELECT source, CAST(count(*) AS BIGINT) AS documents, max(sample_rank) AS last_rank FROM smp GROUP BY source",
        "pretokenize": f"""SELECT doc_id, CAST(len(p) AS BIGINT) AS n_pieces, md5(array_to_string(p, chr(1))) AS pieces_md5,
              array_to_string(p, '') = text AS lossless
              FROM (SELECT doc_id, text, regexp_extract_all({marked}, '{kinds}') AS p FROM ({clean}))""",
        "word_counts": f"""SELECT word, CAST(count(*) AS BIGINT) AS count FROM (
              SELECT unnest(string_split_regex(text, {ws_class})) AS word FROM ({clean})) GROUP BY word""",
        "encode_corpus": f"""SELECT doc_id, CAST(strlen(text) + 2 AS BIGINT) AS n_tokens,
              md5('1,' || array_to_string({byte_list}, ',') || ',2') AS ids_md5 FROM ({clean})""",
        "encode_plain": f"""SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_tokens,
              md5(array_to_string({byte_list}, ',')) AS ids_md5 FROM ({clean})""",
        "decode_tokens": f"SELECT doc_id, md5(text) AS text_md5 FROM ({clean})",
    }


SQL = _sql()
