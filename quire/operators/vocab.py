"""Vocabulary: document sampling, pre-tokenization, word counts, the byte-level BPE model and
its files. Training is in ``bpe_train``, encoding and decoding in ``bpe_encode``."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.config import SPECIAL_TOKENS, shares
from quire.functions.hashing import hex_bucket, order_key
from quire.functions.text import col_of
from quire.plans.materialize import checkpointed
from quire.plans.prefix import bucketed_rank, exclusive_prefix_sums

# The GPT-2 byte-level pre-tokenization pattern.
GPT2_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=1)
def byte_to_unicode() -> list[str]:
    """GPT-2 byte-level alphabet: printable Latin-1 bytes map to themselves, the rest
    to consecutive code points from 256, in byte order."""
    keep = list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1)) + list(range(ord("®"), ord("ÿ") + 1))
    table, extra = {}, 0
    for b in range(256):
        if b in keep:
            table[b] = chr(b)
        else:
            table[b] = chr(256 + extra)
            extra += 1
    return [table[b] for b in range(256)]


# ---------------------------------------------------------------- sampling and counts


def _ranked_sample(docs: DataFrame, src_q: DataFrame, seed: int) -> DataFrame:
    keyed = docs.withColumn("__k", order_key(seed, "source", "doc_id")).withColumn("__b", hex_bucket(F.col("__k"), 3))
    ranked = bucketed_rank(keyed, ["source"], "__b", ["__k", "doc_id"], "sample_rank").drop("__k", "__b")
    # src_q has one row per configured source.
    return ranked.join(F.broadcast(src_q), "source").where(F.col("sample_rank") <= F.col("quota"))


def _in_sample(docs: DataFrame, src_q: DataFrame, seed: int) -> DataFrame:
    """The documents of ``_ranked_sample`` without their ranks. Only keys are shuffled: they
    tell the last key of every source, and the texts before it are kept where they stand."""
    key = order_key(seed, "source", "doc_id")
    keys = docs.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n")).withColumn("__k", key).withColumn("__b", hex_bucket(F.col("__k"), 3))
    placed = exclusive_prefix_sums(keys, ["source"], "__b", ["__k", "doc_id"], {"before": "n"}).join(F.broadcast(src_q), "source")
    last = placed.where(F.col("before") < F.col("quota")).groupBy("source").agg(
        F.max(F.struct("__k", "doc_id", "n", (F.col("quota") - F.col("before")).alias("room"))).alias("last")
    )
    last = checkpointed(last, "sample-last")  # one row per configured source
    at, end = F.struct(key.alias("__k"), "doc_id"), F.struct("last.__k", "last.doc_id")
    near = docs.join(F.broadcast(last), "source")
    uneven = F.col("last.n") > F.col("last.room")
    inside = near.where((at < end) | ((at == end) & ~uneven)).select(*docs.columns)
    if last.where(uneven).isEmpty():
        return inside
    # Documents that share the last id don't all have room.
    some = near.where((at == end) & uneven)
    nth = F.row_number().over(Window.partitionBy("source").orderBy(*[F.col(c) for c in docs.columns if c != "source"]))
    return inside.unionAll(some.withColumn("__nth", nth).where(F.col("__nth") <= F.col("last.room")).select(*docs.columns))


def sample_documents(docs: DataFrame, spark: SparkSession, mix, total_docs: int, seed: int, ranked: bool = True) -> DataFrame:
    """Per source: the first ``sample_documents`` (when set) or ``max(1, int(total x
    share))`` valid documents in seeded order. ``docs`` are cleaned (source, doc_id, …).
    Without ``ranked`` they come without ``sample_rank`` and ``quota``, their texts unshuffled."""
    part = shares(mix)
    rows = [(s.name, s.sample_documents or max(1, int(total_docs * part[s.name]))) for s in mix.sources]
    return (_ranked_sample if ranked else _in_sample)(docs, spark.createDataFrame(rows, "source string, quota long"), seed)


def sample_documents_scaled(docs: DataFrame, spark: SparkSession, mix, fraction: float, seed: int, ranked: bool = True) -> DataFrame:
    """``sample_documents`` with ``total = floor(fraction x valid documents)``, computed
    in Spark (a per-source count and a window over the small source table)."""
    part = shares(mix)
    rows = [(s.name, part[s.name], s.sample_documents or 0) for s in mix.sources]
    src = spark.createDataFrame(rows, "source string, share double, fixed int")
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    src = src.join(counts, "source", "left").fillna(0, ["n"])
    tot = F.floor(F.sum("n").over(Window.partitionBy()).cast("double") * F.lit(fraction)).cast("double")
    quota = F.when(F.col("fixed") > 0, F.col("fixed")).otherwise(F.greatest(F.floor(tot * F.col("share")).cast("long"), F.lit(1)))
    return (_ranked_sample if ranked else _in_sample)(docs, src.select("source", quota.cast("long").alias("quota")), seed)


def pretokenize(text: str | Column) -> Column:
    """Byte-level pre-tokenization pieces (no prefix space), Unicode classes on."""
    return F.regexp_extract_all(col_of(text), F.lit("(?U)" + GPT2_PATTERN), 0)


def word_counts(df: DataFrame, pieces: str | Column) -> DataFrame:
    """Corpus-wide piece frequencies: ``word, count`` (one shuffle, map-side combine)."""
    # explode_outer + null filter: a plain explode makes Catalyst re-evaluate the piece
    # expression in an inferred "non-empty" filter.
    words = df.select(F.explode_outer(col_of(pieces)).alias("word")).where(F.col("word").isNotNull())
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


# ---------------------------------------------------------------- BPE model


@dataclass
class BPEModel:
    vocab: list[str]  # id -> token string
    merges: list[tuple[str, str]] = field(default_factory=list)
    specials: list[str] = field(default_factory=lambda: list(SPECIAL_TOKENS))

    @property
    def token_to_id(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.vocab)}

    def to_json(self) -> str:
        return json.dumps({"vocab": self.vocab, "merges": [list(m) for m in self.merges], "specials": self.specials}, ensure_ascii=False)

    @classmethod
    def from_json(cls, text: str) -> "BPEModel":
        d = json.loads(text)
        return cls(d["vocab"], [tuple(m) for m in d["merges"]], d.get("specials", list(SPECIAL_TOKENS)))

    def metadata(self, data_config: dict | None = None) -> dict:
        ids = self.token_to_id
        return {
            "vocab_size": len(self.vocab),
            "special_tokens": {
                "pad_token": "<pad>", "bos_token": "<bos>", "eos_token": "<eos>", "unk_token": "<unk>",
                "pad_token_id": ids.get("<pad>"), "bos_token_id": ids.get("<bos>"),
                "eos_token_id": ids.get("<eos>"), "unk_token_id": ids.get("<unk>"),
            },
            "data_config": data_config or {},
        }


REQUIRED = ("<pad>", "<bos>", "<eos>", "<unk>")


def check_specials(model: BPEModel) -> None:
    missing = [t for t in REQUIRED if t not in model.token_to_id]
    if missing:
        raise ValueError(f"the vocabulary lacks special tokens: {', '.join(missing)}")


def save_tokenizer(model: BPEModel, folder: str, data_config: dict | None = None) -> None:
    """``tokenizer.json`` (the public library's format, which other tools load) and
    ``tokenizer_meta.json``."""
    check_specials(model)
    ids = model.token_to_id
    special = [
        {"id": ids[t], "content": t, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
        for t in model.specials
    ]
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    around = lambda name: {"SpecialToken": {"id": name, "type_id": 0}}
    template = {
        "type": "TemplateProcessing",
        "single": [around("<bos>"), {"Sequence": {"id": "A", "type_id": 0}}, around("<eos>")],
        "pair": [around("<bos>"), {"Sequence": {"id": "A", "type_id": 0}}, around("<eos>"), {"Sequence": {"id": "B", "type_id": 1}}, around("<eos>")],
        "special_tokens": {t: {"id": t, "ids": [ids[t]], "tokens": [t]} for t in ("<bos>", "<eos>")},
    }
    doc = {
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": special, "normalizer": None,
        "pre_tokenizer": byte_level, "post_processor": template, "decoder": byte_level,
        "model": {
            "type": "BPE", "dropout": None, "unk_token": "<unk>", "continuing_subword_prefix": None, "end_of_word_suffix": None,
            "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": ids, "merges": [list(m) for m in model.merges],
        },
    }
    os.makedirs(folder, exist_ok=True)
    for name, value in (("tokenizer.json", doc), ("tokenizer_meta.json", model.metadata(data_config))):
        with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
            json.dump(value, f, ensure_ascii=False, indent=2)


def byte_words(wc: DataFrame) -> DataFrame:
    """``word, count`` → ``bytes array<int>`` (UTF-8 byte values) and ``count``."""
    from quire.functions.tokenizers import utf8_bytes

    return wc.select(utf8_bytes("word").alias("bytes"), F.col("count").cast("long").alias("count"))


def model_tables(spark: SparkSession, model: BPEModel) -> tuple[DataFrame, DataFrame]:
    """``vocab(id, token)`` and ``merges(rank, left, right)`` (bounded by vocab size)."""
    vocab = spark.createDataFrame(list(enumerate(model.vocab)), "id int, token string")
    merges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(model.merges)], "rank int, left string, right string")
    return vocab, merges
