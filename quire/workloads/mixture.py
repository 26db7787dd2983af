"""Mixture workloads over ``documents`` (Spark side and the matching SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.hashing import hex_bucket, order_key
from quire.functions.tokenizers import ByteTokenizer
from quire.operators import mixture as mx
from quire.plans.materialize import checkpointed
from quire.plans.prefix import bucketed_rank
from quire.sources.corpus import clean_corpus, corpus_from_table, read_table, tokenized_corpus
from quire.workloads.common import (
    SEED,
    SQL_SOURCES,
    TRAIN_FRACTION,
    VAL_FRACTION,
    shard_sizes,
    sql_allocate,
    sql_byte_docs,
    sql_double,
    sql_strip,
    table_mixture,
)

# ---------------------------------------------------------------- Spark side


def sourced(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_from_table(read_table(spark, sf, "documents")).where(F.col("source").isNotNull())


def byte_docs(spark: SparkSession, sf: str) -> DataFrame:
    """The light per-document table (``source, doc_id, n_tokens``), checkpointed: every
    later pass reads it instead of re-scanning and re-tokenizing the corpus."""
    docs = sourced(spark, sf)
    return checkpointed(tokenized_corpus(docs, ByteTokenizer()).select("source", "doc_id", "n_tokens"))


def targets(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """Per-source targets: one row per source of the table, written once."""
    docs = byte_docs(spark, sf) if docs is None else docs
    return checkpointed(mx.fraction_budget(docs, mx.source_table(spark, table_mixture(spark, sf)), TRAIN_FRACTION, VAL_FRACTION), "targets")


def plan(spark: SparkSession, sf: str) -> DataFrame:
    docs = byte_docs(spark, sf)
    return mx.plan_mixture(docs, targets(spark, sf, docs), seed=SEED)


def q_scan_corpus(spark, sf):
    docs = corpus_from_table(read_table(spark, sf, "documents"))
    return docs.select("source", "doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def q_clean_text(spark, sf):
    docs = clean_corpus(corpus_from_table(read_table(spark, sf, "documents")))
    return docs.select("source", "doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"))


def q_drop_untokenized(spark, sf):
    return byte_docs(spark, sf).groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("n_tokens").alias("tokens")
    )


def q_seeded_shuffle(spark, sf):
    docs = corpus_from_table(read_table(spark, sf, "documents")).select("source", "doc_id")
    keyed = docs.withColumn("skey", order_key(SEED, "source", "doc_id")).withColumn("sbucket", hex_bucket(F.col("skey"), 3))
    return bucketed_rank(keyed, ["source"], "sbucket", ["skey", "doc_id"], "shuffle_rank").select(
        "source", "doc_id", "skey", "shuffle_rank"
    )


def q_allocate_targets(spark, sf):
    return targets(spark, sf).select(
        "source", "available_docs", "available_tokens", "train_target", "val_target"
    )


def q_take_budget(spark, sf):
    docs = byte_docs(spark, sf)
    sel = mx.take_budget(docs, targets(spark, sf, docs), SEED)
    return sel.select("split", "source", "doc_id", "n_tokens", "src_cum", "cum", "target")


def q_truncate_last(spark, sf):
    docs = byte_docs(spark, sf)
    sel = mx.select_budget(docs, targets(spark, sf, docs), SEED)
    return sel.where(F.col("n_written") < F.col("n_tokens")).select("split", "source", "doc_id", "n_tokens", "n_written")


def q_split_val_train(spark, sf):
    docs = byte_docs(spark, sf)
    sel = mx.select_budget(docs, targets(spark, sf, docs), SEED)
    return sel.groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n_written").alias("tokens"),
        F.min("doc_id").alias("min_doc"),
        F.max("doc_id").alias("max_doc"),
    )


def q_interleave(spark, sf):
    return plan(spark, sf).select("split", "seq", "source", "doc_id", "cum", "n_written")


def q_assign_offsets(spark, sf):
    return plan(spark, sf).select("split", "doc_id", "stream_offset", "n_written")


def q_assign_shards(spark, sf):
    pieces = mx.assign_shards(plan(spark, sf), shard_sizes())
    return pieces.select("split", "shard", "shard_pos", "doc_id", "doc_start", "length")


def q_shard_manifest(spark, sf):
    return mx.shard_manifest(mx.assign_shards(plan(spark, sf), shard_sizes()))


def q_mix_report(spark, sf):
    docs = byte_docs(spark, sf)
    t = targets(spark, sf, docs)
    return mx.mix_report(mx.select_budget(docs, t, SEED), t)


def q_shortage_check(spark, sf):
    docs = byte_docs(spark, sf)
    t = targets(spark, sf, docs)
    rep = mx.shortage_check(mx.mix_report(mx.select_budget(docs, t, SEED), t))
    return rep.select("source", "train_short", "val_short")


def q_mix_drift(spark, sf):
    docs = byte_docs(spark, sf)
    t = targets(spark, sf, docs)
    d = mx.mix_drift(mx.select_budget(docs, t, SEED), t)
    return d.select("split", "source", "tokens", F.round(F.col("actual_share") * 1e6).cast("long").alias("actual_ppm"),
                    F.round(F.col("share") * 1e6).cast("long").alias("weight_ppm"))


def q_token_stats(spark, sf):
    docs = byte_docs(spark, sf)
    return mx.token_stats(mx.select_budget(docs, targets(spark, sf, docs), SEED))


def q_chain_sources(spark, sf):
    """Config-driven scan: one reader per configured source (same file, a row filter
    each), projected to its text field and chained."""
    from quire.config import DataMixConfig, SourceConfig
    from quire.sources.corpus import scan_corpus

    cfg = DataMixConfig(sources=[
        SourceConfig(name=s.name, path=f"{sf.rstrip('/')}/documents.parquet", text_field="text", row_filters={"source": s.name})
        for s in table_mixture(spark, sf).sources
    ])
    docs = scan_corpus(spark, cfg, id_field="doc_id")
    return docs.select("source", "doc_id", F.md5("text").alias("text_md5"))


def q_budget_prefilter(spark, sf):
    """The interleaved plan, tokenizing only a verified seeded-order prefix of each
    source (estimate: characters + 2, always at most the byte count)."""
    from quire.functions.text import clean_text

    tok = ByteTokenizer()
    docs = sourced(spark, sf)
    light = docs.withColumn("text", clean_text("text")).where(F.col("text").isNotNull()).select(
        "source", "doc_id", (F.length("text") + 2).cast("long").alias("est"))
    t = targets(spark, sf)

    def tokenize(kept):
        return kept.join(docs, ["source", "doc_id"]).withColumn("text", clean_text("text")).select(
            "source", "doc_id", tok.count("text").alias("n_tokens"))

    p = mx.plan_with_prefilter(light, t, tokenize, seed=SEED, margin=1.05)
    return p.select("split", "seq", "source", "doc_id", "cum", "n_written")


QUERIES = {
    "scan_corpus": q_scan_corpus,
    "clean_text": q_clean_text,
    "drop_untokenized": q_drop_untokenized,
    "seeded_shuffle": q_seeded_shuffle,
    "allocate_targets": q_allocate_targets,
    "take_budget": q_take_budget,
    "truncate_last": q_truncate_last,
    "split_val_train": q_split_val_train,
    "interleave": q_interleave,
    "assign_offsets": q_assign_offsets,
    "assign_shards": q_assign_shards,
    "shard_manifest": q_shard_manifest,
    "mix_report": q_mix_report,
    "shortage_check": q_shortage_check,
    "mix_drift": q_mix_drift,
    "token_stats": q_token_stats,
    "chain_sources": q_chain_sources,
    "budget_prefilter": q_budget_prefilter,
}

# ---------------------------------------------------------------- SQL side


def sql_plan_ctes() -> str:
    return f"""
WITH src AS (SELECT * FROM {SQL_SOURCES}),
docs AS ({sql_byte_docs()}),
avail AS (SELECT source, count(*) AS available_docs, sum(n_tokens) AS available_tokens FROM docs GROUP BY source),
srcav AS (
  SELECT s.*, CAST(coalesce(a.available_docs, 0) AS BIGINT) AS available_docs,
         CAST(coalesce(a.available_tokens, 0) AS BIGINT) AS available_tokens
  FROM src s LEFT JOIN avail a USING (source)),
srctot AS (
  SELECT *, CAST(floor(CAST(sum(available_tokens) OVER () AS DOUBLE) * {sql_double(TRAIN_FRACTION)}) AS BIGINT) AS __train_total,
            CAST(floor(CAST(sum(available_tokens) OVER () AS DOUBLE) * {sql_double(VAL_FRACTION)}) AS BIGINT) AS __val_total
  FROM srcav),
t1 AS ({sql_allocate('srctot', '__train_total', 'train_target')}),
tg AS (SELECT * EXCLUDE (__train_total, __val_total) FROM ({sql_allocate('t1', '__val_total', 'val_target')})),
ordered AS (SELECT d.*, md5('{SEED}:' || d.source || ':' || CAST(d.doc_id AS VARCHAR)) AS skey FROM docs d),
cumd AS (
  SELECT o.*, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY skey, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS src_cum
  FROM ordered o),
wt AS (
  SELECT c.*, t.train_target, t.val_target, (t.val_target > 0 AND c.src_cum < t.val_target) AS is_val
  FROM cumd c JOIN tg t USING (source)),
wv AS (SELECT *, coalesce(max(CASE WHEN is_val THEN src_cum + n_tokens END) OVER (PARTITION BY source), 0) AS val_consumed FROM wt),
sel AS (
  SELECT *,
    CASE WHEN is_val THEN 'val'
         WHEN train_target > 0 AND src_cum - val_consumed >= 0 AND src_cum - val_consumed < train_target THEN 'train' END AS split,
    CAST(CASE WHEN is_val THEN src_cum ELSE src_cum - val_consumed END AS BIGINT) AS cum,
    CAST(CASE WHEN is_val THEN val_target ELSE train_target END AS BIGINT) AS target
  FROM wv),
budget AS (SELECT *, CAST(least(n_tokens, target - cum) AS BIGINT) AS n_written FROM sel WHERE split IS NOT NULL),
staged AS (
  SELECT *, CAST(cum AS DOUBLE) / CAST(target AS DOUBLE) AS progress,
         md5('{SEED}:' || split || ':' || source || ':' || CAST(doc_id AS VARCHAR)) AS tiebreak
  FROM budget),
plan AS (
  SELECT *,
    CAST(row_number() OVER (PARTITION BY split ORDER BY progress, tiebreak) AS BIGINT) AS seq,
    CAST(coalesce(sum(n_written) OVER (PARTITION BY split ORDER BY progress, tiebreak
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS stream_offset
  FROM staged),
pieces AS (
  SELECT *, CAST(greatest(stream_offset, shard * size) AS BIGINT) AS __start,
            CAST(least(stream_offset + n_written, (shard + 1) * size) AS BIGINT) AS __end
  FROM (
    SELECT *, unnest(range(stream_offset // size, (stream_offset + n_written - 1) // size + 1)) AS shard
    FROM (SELECT *, CAST(CASE WHEN split = 'val' THEN {shard_sizes()['val']} ELSE {shard_sizes()['train']} END AS BIGINT) AS size FROM plan))),
report AS (
  SELECT t.source, t.train_target AS train_target_tokens, t.val_target AS val_target_tokens,
    CAST(coalesce(sum(CASE WHEN p.split = 'train' THEN p.n_written ELSE 0 END), 0) AS BIGINT) AS train_tokens_written,
    CAST(coalesce(sum(CASE WHEN p.split = 'val' THEN p.n_written ELSE 0 END), 0) AS BIGINT) AS val_tokens_written,
    CAST(count(p.doc_id) AS BIGINT) AS documents_used
  FROM tg t LEFT JOIN plan p USING (source)
  GROUP BY t.source, t.train_target, t.val_target)
"""


_DOC_CLEAN = f"WHERE text IS NOT NULL AND {sql_strip('text')} <> ''"

SQL = {
    "scan_corpus": "SELECT source, doc_id, md5(text) AS text_md5, CAST(length(text) AS BIGINT) AS n_chars FROM documents",
    "clean_text": f"SELECT source, doc_id, md5({sql_strip('text')}) AS text_md5, CAST(length({sql_strip('text')}) AS BIGINT) AS n_chars "
    f"FROM documents {_DOC_CLEAN}",
    "drop_untokenized": sql_plan_ctes()
    + "SELECT source, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY source",
    "seeded_shuffle": f"""SELECT source, doc_id, skey,
        CAST(row_number() OVER (PARTITION BY source ORDER BY skey, doc_id) AS BIGINT) AS shuffle_rank
      FROM (SELECT source, doc_id, md5('{SEED}:' || source || ':' || CAST(doc_id AS VARCHAR)) AS skey FROM documents)""",
    "allocate_targets": sql_plan_ctes()
    + "SELECT source, available_docs, available_tokens, train_target, val_target FROM tg",
    "take_budget": sql_plan_ctes() + "SELECT split, source, doc_id, n_tokens, src_cum, cum, target FROM budget",
    "truncate_last": sql_plan_ctes()
    + "SELECT split, source, doc_id, n_tokens, n_written FROM budget WHERE n_written < n_tokens",
    "split_val_train": sql_plan_ctes()
    + """SELECT split, source, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n_written) AS BIGINT) AS tokens,
            min(doc_id) AS min_doc, max(doc_id) AS max_doc FROM budget GROUP BY split, source""",
    "interleave": sql_plan_ctes() + "SELECT split, seq, source, doc_id, cum, n_written FROM plan",
    "assign_offsets": sql_plan_ctes() + "SELECT split, doc_id, stream_offset, n_written FROM plan",
    "assign_shards": sql_plan_ctes()
    + """SELECT split, CAST(shard AS BIGINT) AS shard, CAST(__start - shard * size AS BIGINT) AS shard_pos, doc_id,
            CAST(__start - stream_offset AS BIGINT) AS doc_start, CAST(__end - __start AS BIGINT) AS length FROM pieces""",
    "shard_manifest": sql_plan_ctes()
    + """SELECT split, CAST(shard AS BIGINT) AS shard, printf('%s_%05d.bin', split, CAST(shard AS INTEGER)) AS path,
            CAST(sum(__end - __start) AS BIGINT) AS num_tokens, 'uint16' AS dtype FROM pieces GROUP BY split, shard""",
    "mix_report": sql_plan_ctes() + "SELECT * FROM report",
    "shortage_check": sql_plan_ctes()
    + """SELECT source, CAST(train_target_tokens - train_tokens_written AS BIGINT) AS train_short,
            CAST(val_target_tokens - val_tokens_written AS BIGINT) AS val_short FROM report""",
    "mix_drift": sql_plan_ctes()
    + """SELECT w.split, w.source, w.tokens,
            CAST(round(CAST(w.tokens AS DOUBLE) / CAST(sum(w.tokens) OVER (PARTITION BY w.split) AS DOUBLE) * 1e6) AS BIGINT) AS actual_ppm,
            CAST(round(s.share * 1e6) AS BIGINT) AS weight_ppm
         FROM (SELECT split, source, CAST(sum(n_written) AS BIGINT) AS tokens FROM plan GROUP BY split, source) w
         LEFT JOIN src s USING (source)""",
    "chain_sources": "SELECT source, doc_id, md5(text) AS text_md5 FROM documents WHERE source IS NOT NULL",
    "budget_prefilter": sql_plan_ctes() + "SELECT split, seq, source, doc_id, cum, n_written FROM plan",
    "token_stats": sql_plan_ctes()
    + """SELECT split, source, CAST(count(*) AS BIGINT) AS documents, CAST(sum(n_written) AS BIGINT) AS tokens,
            min(n_written) AS min_tokens, max(n_written) AS max_tokens FROM plan GROUP BY split, source""",
}
