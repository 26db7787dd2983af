"""Pretraining windows and validation loss over the mixed, sharded corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.tokenizers import ByteTokenizer
from quire.operators import mixture as mx
from quire.operators import scoring as sc
from quire.operators import windows as wn
from quire.operators.unigram import fit_unigram
from quire.sources.corpus import clean_corpus, corpus_from_table, read_table
from quire.workloads import mixture as wm
from quire.plans.materialize import checkpointed
from quire.workloads.common import SEED, shard_sizes

SEQ_LEN = 256
BATCH = 4
EVAL_MODEL = "all sources"


def pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Shard pieces of the mixed stream (light columns), checkpointed once."""
    return checkpointed(mx.assign_shards(wm.plan(spark, sf), shard_sizes()))


def pieces_with_ids(spark: SparkSession, sf: str, pcs: DataFrame | None = None) -> DataFrame:
    """Pieces with their own tokens (the document's ids sliced to the piece)."""
    pcs = pieces(spark, sf) if pcs is None else pcs
    docs = clean_corpus(corpus_from_table(read_table(spark, sf, "documents"))).select("source", "doc_id", "text")
    # Join first, then tokenize: only documents that made it into the mixture are encoded.
    joined = pcs.join(docs, ["source", "doc_id"])
    ids = ByteTokenizer().encode("text")
    return joined.withColumn("tokens", F.slice(ids, F.col("doc_start") + 1, F.col("length"))).drop("text")


def manifest(spark, sf, pcs: DataFrame | None = None) -> DataFrame:
    pcs = pieces(spark, sf) if pcs is None else pcs
    return checkpointed(mx.shard_manifest(pcs))


def filled(spark, sf) -> DataFrame:
    pcs = pieces(spark, sf)
    tok = wn.window_tokens(manifest(spark, sf, pcs), pieces_with_ids(spark, sf, pcs), SEQ_LEN)
    inputs, labels, _ = wn.shift_labels("tokens", SEQ_LEN)
    return tok.withColumn("input_ids", inputs).withColumn("labels", labels)


def eval_logprobs(spark, sf) -> list[float]:
    docs = clean_corpus(corpus_from_table(read_table(spark, sf, "documents"))).withColumn("model", F.lit(EVAL_MODEL))
    lm = fit_unigram(docs, model_col="model").orderBy("token_id")
    return [r.logprob for r in lm.select("logprob").collect()]  # 260 values: the vocabulary


def losses(spark, sf) -> DataFrame:
    val = filled(spark, sf).where(F.col("split") == "val")
    nll = wn.window_nll(val, eval_logprobs(spark, sf), SEQ_LEN, BATCH)
    return sc.eval_loss(wn.batch_losses(nll), keys=["split"], batch="batch", nll="batch_loss")


def q_sequential_windows(spark, sf):
    return wn.sequential_windows(manifest(spark, sf), SEQ_LEN).select("split", "shard", "start", "window_idx")


def q_random_windows(spark, sf):
    man = manifest(spark, sf)
    total = man.where(F.col("split") == "train").agg(F.sum("num_tokens")).first()[0]
    n = int(total // (SEQ_LEN + 1))  # one pass worth of windows
    return wn.random_windows(spark, man, n, SEQ_LEN, SEED).select("draw", "shard", "start")


def q_shift_labels(spark, sf):
    f = filled(spark, sf)
    return f.select(
        "split", "window_idx", F.md5(F.array_join("input_ids", ",")).alias("inputs_md5"),
        F.md5(F.array_join("labels", ",")).alias("labels_md5"), F.size("tokens").cast("long").alias("n_tokens"),
    )


def q_eval_loss(spark, sf):
    return losses(spark, sf).select("split", F.round("val_loss", 9).alias("val_loss"), "eval_batches")


def q_perplexity(spark, sf):
    return losses(spark, sf).select("split", F.round(sc.perplexity("val_loss"), 6).alias("perplexity"))


QUERIES = {
    "sequential_windows": q_sequential_windows,
    "random_windows": q_random_windows,
    "shift_labels": q_shift_labels,
    "eval_loss": q_eval_loss,
    "perplexity": q_perplexity,
}

# ---------------------------------------------------------------- SQL side


def _ctes() -> str:
    from quire.workloads.scoring import sql_byte_ids, sql_lm_ctes

    L = SEQ_LEN
    mix = wm.sql_plan_ctes()
    lm = sql_lm_ctes(f"'{EVAL_MODEL}'").strip()
    assert lm.startswith("WITH")
    return mix.rstrip() + ",\n" + lm[4:] + f""",
pc AS (
  SELECT split, CAST(shard AS BIGINT) AS shard, source, doc_id, __start - shard * size AS shard_pos,
         __start - stream_offset AS doc_start, __end - __start AS length FROM pieces),
man AS (SELECT split, shard, CAST(sum(length) AS BIGINT) AS num_tokens FROM pc GROUP BY split, shard),
wins AS (
  SELECT split, shard, num_tokens, start,
         CAST(row_number() OVER (PARTITION BY split ORDER BY shard, start) - 1 AS BIGINT) AS window_idx
  FROM (SELECT *, unnest(range(0, num_tokens - {L + 1}, {L})) AS start FROM man)),
dids AS (SELECT source, doc_id, list_concat([1], {sql_byte_ids('text')}, [2]) AS ids FROM cdocs),
stream AS (
  SELECT split, shard, shard_pos + i AS p, ids[doc_start + i + 1] AS t
  FROM (SELECT pc.*, d.ids, unnest(range(pc.length)) AS i FROM pc JOIN dids d USING (source, doc_id))),
wtok AS (
  SELECT w.split, w.window_idx, s.p, s.t, w.start
  FROM wins w JOIN stream s ON s.split = w.split AND s.shard = w.shard AND s.p >= w.start AND s.p <= w.start + {L}),
filled AS (
  SELECT split, window_idx,
         md5(string_agg(CAST(t AS VARCHAR), ',' ORDER BY p) FILTER (WHERE p < start + {L})) AS inputs_md5,
         md5(string_agg(CAST(t AS VARCHAR), ',' ORDER BY p) FILTER (WHERE p > start)) AS labels_md5,
         CAST(count(*) AS BIGINT) AS n_tokens
  FROM wtok GROUP BY split, window_idx),
nll AS (
  SELECT w.split, w.window_idx // {BATCH} AS batch, -lm.logprob AS nll
  FROM wtok w JOIN lm ON lm.model = '{EVAL_MODEL}' AND lm.token_id = w.t
  WHERE w.split = 'val' AND w.p > w.start),
ev AS (
  SELECT split, avg(bl) AS val_loss, CAST(count(*) AS BIGINT) AS eval_batches
  FROM (SELECT split, batch, sum(nll) / count(*) AS bl FROM nll GROUP BY split, batch) GROUP BY split)
"""


def _sql():
    C = _ctes()
    L = SEQ_LEN
    return {
        "sequential_windows": C + "SELECT split, shard, start, window_idx FROM wins",
        "random_windows": C + f""", caps AS (
              SELECT shard, num_tokens - {L + 1} AS cap,
                     coalesce(sum(num_tokens - {L + 1}) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum
              FROM man WHERE split = 'train' AND num_tokens - {L + 1} > 0),
            captot AS (SELECT sum(cap) AS total FROM caps),
            draws AS (
              SELECT d AS draw, CAST(floor(CAST(('0x' || substr(md5('{SEED}:' || CAST(d AS VARCHAR)), 1, 13)) AS BIGINT) / {float(16**13)!r}
                                      * (SELECT total FROM captot)) AS BIGINT) AS g
              FROM range((SELECT CAST(sum(num_tokens) // {L + 1} AS BIGINT) FROM man WHERE split = 'train')) t(d))
            SELECT d.draw, c.shard, CAST(d.g - c.cum AS BIGINT) AS start FROM draws d JOIN caps c ON d.g >= c.cum AND d.g < c.cum + c.cap""",
        "shift_labels": C + "SELECT split, window_idx, inputs_md5, labels_md5, n_tokens FROM filled",
        "eval_loss": C + "SELECT split, round(val_loss, 9) AS val_loss, eval_batches FROM ev",
        "perplexity": C + "SELECT split, round(exp(least(val_loss, 20.0)), 6) AS perplexity FROM ev",
    }


SQL = _sql()
