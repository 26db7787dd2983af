"""Shard write/read round trips (token shards from the mixture, fine-tuning shards
from the chat build). Each query writes below the session's checkpoint folder and
reads the files back with the Python Data Sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import chat as ch
from quire.plans.materialize import checkpointed
from quire.session import posix_scratch
from quire.sources import shards as sh
from quire.workloads import chat as wc
from quire.workloads import windows as ww
from quire.workloads.common import SEED

CHUNK = 4096


def _write_tokens(spark: SparkSession, sf: str) -> str:
    root = posix_scratch(spark, "token-shards")
    pcs = ww.pieces(spark, sf)
    sizes = {r.split: (r.shards, r.tokens) for r in pcs.groupBy("split").agg((F.max("shard") + 1).alias("shards"), F.sum("length").alias("tokens")).collect()}
    pieces = checkpointed(ww.pieces_with_ids(spark, sf, pcs), "token-pieces")  # joined and encoded once for both splits
    for split in ("val", "train"):
        shards, tokens = sizes.get(split, (0, 0))
        sh.write_token_shards(pieces.where(F.col("split") == split), f"{root}/{split}", split, shards=shards, tokens=tokens)
    return root


def q_write_token_shards(spark, sf):
    root = _write_tokens(spark, sf)
    frames = []
    for split in ("val", "train"):
        m = spark.read.option("multiLine", "true").json(f"{root}/{split}/{split}_manifest.json")
        frames.append(m.select(F.lit(split).alias("split"), "path", F.col("num_tokens").cast("long").alias("num_tokens"), "dtype"))
    return frames[0].unionByName(frames[1])


def q_read_token_shards(spark, sf):
    root = _write_tokens(spark, sf)
    frames = [sh.read_token_shards(spark, f"{root}/{s}", s, chunk_tokens=CHUNK) for s in ("val", "train")]
    df = frames[0].unionByName(frames[1])
    return df.select(
        "split", F.col("shard").cast("long").alias("shard"), "start",
        F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", ",")).alias("tokens_md5"),
    )


def _examples(spark, sf) -> DataFrame:
    e = ch.min_supervised_filter(wc.examples(spark, sf), wc.MIN_SUP)
    out = ch.val_first_n(ch.shuffle_rank(e, SEED, "conv_id"), wc.VAL_EXAMPLES)
    return out.withColumn(
        "row", F.when(F.col("split") == "val", F.col("shuffle_rank") - 1).otherwise(F.col("shuffle_rank") - 1 - wc.VAL_EXAMPLES)
    )


def _write_sft(spark, sf) -> str:
    root = posix_scratch(spark, "sft-shards")
    ex = _examples(spark, sf)
    for split in ("val", "train"):
        sh.write_sft_shards(ex.where(F.col("split") == split), root, split, wc.SEQ_LEN)
    return root


def q_write_sft_shards(spark, sf):
    root = _write_sft(spark, sf)
    frames = []
    for split in ("val", "train"):
        m = spark.read.option("multiLine", "true").json(f"{root}/{split}_metadata.json")
        frames.append(m.select(F.lit(split).alias("split"), F.col("num_examples").cast("long").alias("num_examples"),
                               F.col("seq_len").cast("long").alias("seq_len")))
    return frames[0].unionByName(frames[1])


def q_read_sft_shards(spark, sf):
    root = _write_sft(spark, sf)
    frames = [sh.read_sft_shards(spark, root, s).withColumn("split", F.lit(s)) for s in ("val", "train")]
    df = frames[0].unionByName(frames[1])
    return df.select(
        "split", "row", F.md5(F.array_join("input_ids", ",")).alias("ids_md5"), F.md5(F.array_join("labels", ",")).alias("labels_md5"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).cast("long").alias("mask_sum"),
    )


QUERIES = {
    "write_token_shards": q_write_token_shards,
    "read_token_shards": q_read_token_shards,
    "write_sft_shards": q_write_sft_shards,
    "read_sft_shards": q_read_sft_shards,
}


def _sql():
    W = ww._ctes()
    L = wc.sql_labels_ctes()
    V = wc.VAL_EXAMPLES
    return {
        "write_token_shards": W + """SELECT split, printf('%s_%05d.bin', split, CAST(shard AS INTEGER)) AS path,
              num_tokens, 'uint16' AS dtype FROM man""",
        "read_token_shards": W + f"""SELECT split, shard, CAST(p // {CHUNK} * {CHUNK} AS BIGINT) AS start,
              CAST(count(*) AS BIGINT) AS n_tokens, md5(string_agg(CAST(t AS VARCHAR), ',' ORDER BY p)) AS tokens_md5
            FROM stream GROUP BY split, shard, p // {CHUNK}""",
        "write_sft_shards": L + f"""SELECT CASE WHEN shuffle_rank <= {V} THEN 'val' ELSE 'train' END AS split,
              CAST(count(*) AS BIGINT) AS num_examples, CAST({wc.SEQ_LEN} AS BIGINT) AS seq_len FROM ranked GROUP BY 1""",
        "read_sft_shards": L + f"""SELECT CASE WHEN shuffle_rank <= {V} THEN 'val' ELSE 'train' END AS split,
              CASE WHEN shuffle_rank <= {V} THEN shuffle_rank - 1 ELSE shuffle_rank - 1 - {V} END AS row,
              md5(array_to_string(ids, ',')) AS ids_md5, md5(array_to_string(labs, ',')) AS labels_md5,
              CAST(len(list_filter(ids, lambda x: x <> 0)) AS BIGINT) AS mask_sum FROM ranked""",
    }


SQL = _sql()
