"""Whole builds from a configuration: corpus shards, chat examples, a vocabulary.

Each job wires the operators of this package, writes its files below one folder (a
POSIX path that driver and executors share) and returns its summary, which is also
written there as JSON. Summaries have one entry per configured source, nothing that
grows with the data."""

from __future__ import annotations

import json
import os
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.config import ChatConfig, DataMixConfig
from quire.operators import chat as ch
from quire.operators import mixture as mx
from quire.operators import vocab as vb
from quire.operators.bpe_train import train_bpe
from quire.plans.materialize import checkpointed
from quire.session import ensure_checkpoint_dir, ship_package
from quire.sources import shards as sh
from quire.sources.chat import row_filters, scan_chat
from quire.sources.corpus import clean_corpus, scan_corpus, tokenized_corpus


def _ready(spark: SparkSession, out: str) -> None:
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    os.makedirs(out, exist_ok=True)


def _write_json(path: str, value: dict) -> dict:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False)
    return value


def build_corpus(
    spark: SparkSession, config: DataMixConfig, tokenizer, out: str, id_field: str | None = None,
    seed: int = 42, shortage: str = "error", docs: DataFrame | None = None,
) -> dict:
    """Sources → token shards ``out/val``, ``out/train`` with manifests, and
    ``out/summary.json``. ``docs(source, doc_id, text)`` replaces the scan of the
    configured sources. With ``shortage="error"`` nothing is written when a source runs
    out before its targets. Texts are tokenized twice: once for their lengths, then, of
    the planned documents only, for their ids."""
    _ready(spark, out)
    if getattr(tokenizer, "vocab_size", 0) > 1 << 16:
        raise ValueError("ids of this tokenizer do not fit 16-bit shards")
    docs = scan_corpus(spark, config, id_field) if docs is None else docs
    light = checkpointed(tokenized_corpus(docs, tokenizer).select("source", "doc_id", "n_tokens"), "corpus-lengths")
    targets = mx.source_table(spark, config)
    targets = mx.allocate_targets(targets, config.train_tokens, "train_target")
    targets = checkpointed(mx.allocate_targets(targets, config.val_tokens, "val_target"), "corpus-targets")
    plan = checkpointed(mx.plan_mixture(light, targets, seed=seed), "corpus-plan")
    report = checkpointed(mx.mix_report(plan, targets), "corpus-report")
    mx.enforce_shortage_policy(report, shortage)
    pieces = mx.assign_shards(plan, mx.shard_sizes(config))
    texts = clean_corpus(docs).select("source", "doc_id", "text")
    ids = tokenizer.encode("text")
    tokens = pieces.join(texts, ["source", "doc_id"]).withColumn("tokens", F.slice(ids, F.col("doc_start") + 1, F.col("length")))
    tokens = checkpointed(tokens.select("split", "shard", "shard_pos", "tokens"), "corpus-pieces")
    shards = {r.split: r.n for r in tokens.groupBy("split").agg((F.max("shard") + 1).alias("n")).collect()}
    for split in mx.SPLITS:
        if split in shards:
            sh.write_token_shards(tokens.where(F.col("split") == split), f"{out}/{split}", split, shards=shards[split])
    by_name = {s.name: s for s in config.sources}
    rows = report.collect()  # one row per configured source
    summary = {
        "mixing_strategy": "least progressed source first, by tokens",
        **{f"{s}_target_tokens": sum(r[f"{s}_target_tokens"] for r in rows) for s in mx.SPLITS},
        **{f"{s}_tokens_written": sum(r[f"{s}_tokens_written"] for r in rows) for s in mx.SPLITS},
        **{f"{s}_shards": int(shards.get(s, 0)) for s in mx.SPLITS},
        "sources": {
            r.source: {
                "path": by_name[r.source].path, "data_dir": by_name[r.source].data_dir, "split": by_name[r.source].split,
                **{k: r[k] for k in ("train_target_tokens", "val_target_tokens", "train_tokens_written", "val_tokens_written", "documents_used")},
            }
            for r in sorted(rows, key=lambda r: r.source)
        },
        "tokenizer": {"name": tokenizer.name, "vocab_size": getattr(tokenizer, "vocab_size", None)},
        "data_config": asdict(config),
    }
    return _write_json(f"{out}/summary.json", summary)


def chat_examples(spark: SparkSession, config: ChatConfig, seq_len: int, encode_many=None, frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """Fixed-length examples of every configured source, with ``source`` and a row key."""
    parts = []
    for s in config.sources:
        raw = scan_chat(spark, s) if frames is None else frames[s.source_name]
        valid, _ = ch.validate_chat_rows(row_filters(raw, s.row_filters), config)
        messages = ch.drop_empty_dialogs(ch.to_messages(valid, config)).select("messages")
        # Equal dialogs get distinct keys from their occurrence number, which is the same
        # however the rows are divided over tasks.
        parts.append(messages.withColumn("source", F.lit(s.source_name)))
    dialogs = parts[0]
    for p in parts[1:]:
        dialogs = dialogs.unionByName(p)
    counted = dialogs.groupBy("source", "messages").agg(F.count(F.lit(1)).alias("n"))
    dialogs = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).drop("n")
    dialogs = dialogs.withColumn("key", F.md5(F.concat_ws(":", F.to_json("messages"), F.col("copy").cast("string")))).drop("copy")
    options = {} if encode_many is None else {"encode_many": encode_many}
    return ch.min_supervised_filter(ch.build_examples(dialogs, seq_len, config.min_supervised_tokens, **options), config.min_supervised_tokens)


def _shares(total: int, weights: dict[str, float]) -> dict[str, int]:
    """Whole numbers in proportion to ``weights`` that sum to ``total`` (largest rests first)."""
    whole = sum(weights.values())
    exact = {k: total * w / whole for k, w in weights.items()}
    out = {k: int(v) for k, v in exact.items()}
    for k in sorted(exact, key=lambda k: out[k] - exact[k])[: total - sum(out.values())]:
        out[k] += 1
    return out


def build_chat(
    spark: SparkSession, config: ChatConfig, out: str, seq_len: int, seed: int = 42, encode_many=None, frames: dict[str, DataFrame] | None = None
) -> dict:
    """Chat sources → example shards ``val`` and ``train`` below ``out`` and
    ``out/summary.json``. Validation examples, and the train examples where
    ``max_train_examples`` limits them, are shared out over the sources by weight; within
    a source the seeded order decides."""
    _ready(spark, out)
    examples = checkpointed(chat_examples(spark, config, seq_len, encode_many, frames), "chat-examples")
    weights = {s.source_name: s.weight for s in config.sources}
    val = _shares(config.val_examples, weights)
    train = None if config.max_train_examples is None else _shares(config.max_train_examples, weights)
    quota = spark.createDataFrame([(k, val[k], None if train is None else train[k]) for k in weights], "source string, val long, train long")
    ranked = ch.shuffle_rank(examples, seed, "key", keys=("source",), out="place").join(quota, "source")
    split = F.when(F.col("place") <= F.col("val"), F.lit("val")).when(
        F.col("train").isNull() | (F.col("place") <= F.col("val") + F.col("train")), F.lit("train")
    )
    chosen = ranked.withColumn("split", split).where(F.col("split").isNotNull()).drop("val", "train", "place")
    chosen = checkpointed(ch.shuffle_rank(chosen, seed, "key", keys=("split",), out="row").withColumn("row", F.col("row") - 1), "chat-rows")
    rows = ch.sft_report(chosen, seq_len).collect()  # two rows per source
    for s in ("val", "train"):
        if any(r.split == s for r in rows):
            sh.write_sft_shards(chosen.where(F.col("split") == s), out, s, seq_len)
    summary = {
        "seq_len": seq_len,
        **{f"{s}_examples": sum(r.num_examples for r in rows if r.split == s) for s in ("val", "train")},
        "sources": {
            k: {
                "weight": w,
                **{f"{s}_examples": sum(r.num_examples for r in rows if (r.split, r.source) == (s, k)) for s in ("val", "train")},
                "supervised_tokens": sum(r.supervised_tokens for r in rows if r.source == k),
            }
            for k, w in weights.items()
        },
    }
    return _write_json(f"{out}/summary.json", summary)


def train_vocab(
    spark: SparkSession, config: DataMixConfig, out: str, vocab_size: int, id_field: str | None = None, seed: int = 42, docs: DataFrame | None = None
) -> vb.BPEModel:
    """Sampled documents of the sources → ``out/tokenizer.json`` and
    ``out/tokenizer_meta.json``; the model is returned."""
    _ready(spark, out)
    docs = clean_corpus(scan_corpus(spark, config, id_field) if docs is None else docs)
    sample = vb.sample_documents(docs, spark, config, config.tokenizer_sample_documents, seed, ranked=False)
    words = checkpointed(vb.word_counts(sample, vb.pretokenize("text")), "vocab-words")
    model = train_bpe(spark, words, vocab_size, config.tokenizer_min_frequency, list(config.tokenizer_special_tokens))
    vb.save_tokenizer(model, out, asdict(config))
    return model
