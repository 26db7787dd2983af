"""Whole builds from a configuration."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire import jobs
from quire.config import ChatConfig, ChatSourceConfig, DataMixConfig, SourceConfig
from quire.functions.tokenizers import ByteTokenizer
from quire.operators import bpe_encode as be
from quire.operators import vocab as vb


def _corpus(spark, folder):
    rng = random.Random(2)
    for name, n in (("web", 120), ("code", 60)):
        rows = [(i, " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(rng.randint(3, 30)))) for i in range(n)]
        spark.createDataFrame(rows, "id long, text string").write.mode("overwrite").parquet(f"{folder}/{name}/train")
    sources = [SourceConfig(name="web", path=f"{folder}/web", weight=3.0), SourceConfig(name="code", path=f"{folder}/code", weight=1.0)]
    return DataMixConfig(sources=sources, train_tokens=6000, val_tokens=400, shard_size_tokens=2500)


def test_build_corpus_writes_shards_and_summary(spark, tmp_path):
    config = _corpus(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    summary = jobs.build_corpus(spark, config, ByteTokenizer(), out, id_field="id")
    assert json.load(open(f"{out}/summary.json")) == summary
    assert summary["train_tokens_written"] == 6000 and summary["val_tokens_written"] == 400
    assert summary["sources"]["web"]["train_tokens_written"] == 4500 and summary["train_shards"] == 3 and summary["val_shards"] == 1
    manifest = json.load(open(f"{out}/train/train_manifest.json"))
    assert [m["num_tokens"] for m in manifest] == [2500, 2500, 1000]
    stream = np.concatenate([np.fromfile(f"{out}/train/{m['path']}", "<u2") for m in manifest])
    assert len(stream) == 6000 and stream[0] == 1


def test_build_corpus_aborts_on_a_shortage_before_writing(spark, tmp_path):
    config = _corpus(spark, str(tmp_path / "in"))
    config.train_tokens = 10**7
    with pytest.raises(RuntimeError, match="not enough data"):
        jobs.build_corpus(spark, config, ByteTokenizer(), str(tmp_path / "out"), id_field="id")
    assert not (tmp_path / "out" / "train").exists()
    cut = jobs.build_corpus(spark, config, ByteTokenizer(), str(tmp_path / "cut"), id_field="id", shortage="truncate")
    assert 0 < cut["train_tokens_written"] < 10**7


def test_build_chat_shares_quotas_by_source(spark, tmp_path):
    def dialogs(n, tag):
        rows = [([{"role": "user", "content": f"{tag} {i}"}, {"role": "assistant", "content": "yes " * 8}],) for i in range(n)]
        return spark.createDataFrame(rows + rows[:1], "messages array<struct<role:string,content:string>>")

    config = ChatConfig(val_examples=4, max_train_examples=20, min_supervised_tokens=4,
                        sources=[ChatSourceConfig(source_name="a", weight=3.0), ChatSourceConfig(source_name="b", weight=1.0)])
    out = str(tmp_path / "chat")
    summary = jobs.build_chat(spark, config, out, seq_len=96, frames={"a": dialogs(40, "a"), "b": dialogs(30, "b")})
    assert summary["val_examples"] == 4 and summary["train_examples"] == 20
    assert {k: (v["val_examples"], v["train_examples"]) for k, v in summary["sources"].items()} == {"a": (3, 15), "b": (1, 5)}
    from quire.sources.shards import read_sft_shards

    rows = read_sft_shards(spark, out, "train").collect()
    assert len(rows) == 20 and all(len(r.input_ids) == 96 for r in rows)


def test_train_vocab_files_load_in_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    config = _corpus(spark, str(tmp_path / "in"))
    config.tokenizer_sample_documents = 100
    out = str(tmp_path / "tok")
    jobs.train_vocab(spark, config, out, 90, id_field="id")
    meta = json.load(open(f"{out}/tokenizer_meta.json"))
    assert meta["special_tokens"]["eos_token_id"] == 2 and meta["vocab_size"] <= 90
    lib, ours = Tokenizer.from_file(f"{out}/tokenizer.json"), be.load_tokenizer(out)
    texts = ["abcde fabc  deaf", "", "bad <eos> cafe", "é\n\nfeed " + "abc" * 400]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(ours.encode("t").alias("ids"))
    assert [r.ids for r in df.collect()] == [lib.encode(t).ids for t in texts]


def test_missing_special_tokens_are_an_error(spark, tmp_path):
    model = vb.BPEModel(["<pad>", "<bos>", "a"], [], ["<pad>", "<bos>"])
    with pytest.raises(ValueError, match="<eos>, <unk>"):
        vb.save_tokenizer(model, str(tmp_path))


def test_typed_specials_are_counted_and_can_be_escaped(spark):
    alphabet = sorted({vb.byte_to_unicode()[b] for b in range(256)}, key=ord)
    model = vb.BPEModel(["<pad>", "<bos>", "<eos>", "<unk>", *alphabet], [])
    plain, escaped = be.BPETokenizer(model), be.BPETokenizer(model, escape_specials=True)
    df = spark.createDataFrame([("x<eos>y<eos>",), ("none",)], "t string")
    r = df.select(plain.encode("t", False).alias("a"), escaped.encode("t", False).alias("b"), plain.typed_specials("t").alias("n")).collect()
    assert r[0].n == 2 and r[1].n == 0 and r[0].a.count(2) == 2 and 2 not in r[0].b and len(r[0].b) == 12
    many = df.select(plain.encode_many(F.array("t", "t")).alias("m")).collect()
    assert many[1].m == [r[1].a, r[1].a]
