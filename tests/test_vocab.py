"""Golden tests: BPE training and encoding against the tokenizers library."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions.tokenizers import ByteTokenizer
from quire.operators import bpe_encode as be
from quire.operators import vocab as vb
from quire.operators.bpe_train import train_bpe

TEXTS = [
    "The cat sat on the mat. The cat ate the rat!",
    "Über alles: größer, schöner, été — naïve café 123 456.",
    "hello world hello there, aaa aaaa aaaaa don't won't",
    "  leading spaces and\ttabs\nnew lines\n\n  ",
    "Zahlen 3.14159 und 2,71828; emoji 🙂 done",
] * 3


def _library(vocab, texts=None):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, processors, trainers

    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tr = trainers.BpeTrainer(vocab_size=vocab, min_frequency=2, special_tokens=["<pad>", "<bos>", "<eos>", "<unk>"], show_progress=False)
    tok.train_from_iterator(TEXTS if texts is None else texts, trainer=tr)
    tok.post_processor = processors.TemplateProcessing(single="<bos> $A <eos>", special_tokens=[("<bos>", 1), ("<eos>", 2)])
    return tok


def test_bpe_training_and_encoding_match_library(spark):
    V = 200
    lib = _library(V)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    words = vb.word_counts(df.select(vb.pretokenize("text").alias("p")), "p")
    model = train_bpe(spark, words, V, 2)
    m = json.loads(lib.to_str())["model"]
    lib_merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
    assert model.merges == lib_merges
    assert model.vocab == [t for t, _ in sorted(m["vocab"].items(), key=lambda kv: kv[1])]

    bt = be.BPETokenizer(model)
    probe = TEXTS[:5] + ["hello <eos> world", "unseen ÿ bytes \x00"]
    got = spark.createDataFrame([(t,) for t in probe], "t string").select(bt.encode("t").alias("ids"), "t").collect()
    for r in got:
        assert list(r.ids) == lib.encode(r.t).ids
    back = spark.createDataFrame([(TEXTS[1],)], "t string").select(bt.decode(bt.encode("t")).alias("d")).first().d
    assert back == TEXTS[1]


@pytest.mark.parametrize("vocab, hot, chains", [(500, 64, 300), (2500, 1024, 10_000)])
def test_training_on_the_documents_equals_the_library(spark, vocab, hot, chains):
    """Many small rounds, and the production vocabulary's way with fewer ids."""
    from quire.workloads.vocab import cleaned
    from tests.conftest import SF_MID, SF_SMALL

    docs = cleaned(spark, SF_SMALL if vocab == 500 else SF_MID)
    lib = _library(vocab, [r.text for r in docs.select("text").collect()])
    m = json.loads(lib.to_str())["model"]
    model = train_bpe(spark, vb.word_counts(docs.select(vb.pretokenize("text").alias("p")), "p"), vocab, 2, hot=hot, chains=chains)
    assert model.merges == [tuple(x) for x in m["merges"]]
    assert model.vocab == [t for t, _ in sorted(m["vocab"].items(), key=lambda kv: kv[1])]
    assert len(model.vocab) == vocab and model.rounds > 3
    assert model.touched[-1] < model.touched[0] / 2  # work falls with the words touched
    if vocab == 2500:
        coded = be.encode_documents(docs, be.BPETokenizer(model), frequent=500)
        for r in coded.orderBy("doc_id").collect():
            assert list(r.ids) == lib.encode(r.text).ids


def test_repeated_symbols_and_one_link_a_round(spark):
    """Runs of one symbol, tokens that come about twice, rounds of one pair or chain."""
    rng = random.Random(4)
    texts = ["".join(rng.choice("aab") for _ in range(rng.randint(1, 14))) for _ in range(150)] + ["a" * 40]
    lib = [tuple(x) for x in json.loads(_library(90, texts).to_str())["model"]["merges"]]
    words = spark.createDataFrame([(w, 1) for t in texts for w in [t]], "word string, count long").groupBy("word").agg({"count": "sum"}).toDF("word", "count")
    for size, hot, chains in ((9, 1, 1), (14, 3, 2), (90, 500, 10_000)):
        model = train_bpe(spark, words, size, 2, hot=hot, chains=chains)
        assert model.merges == (lib if size == 90 else lib[: size - 6])


def test_blocks_of_words_are_merged_as_single_words_are():
    import numpy as np

    from quire.operators import bpe_train as bt

    rng = random.Random(3)
    for _ in range(60):
        words = [[rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(0, 40))]
        known, merges = 4, {}
        for rank in range(rng.randint(1, 9)):
            key = rng.randrange(known) << bt.SHIFT | rng.randrange(known)
            if key not in merges:
                merges[key] = (len(merges), known)
                known += 1
        keys = np.array(sorted(merges), "i8")
        ranks, made = np.array([merges[int(k)][0] for k in keys]), np.array([new for _, new in merges.values()], "i8")
        ends = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype("i8")
        which, flat, size = bt.merge_words(np.array([x for w in words for x in w], "i8"), ends, keys, ranks, made)
        now = [bt.merge_symbols(w, merges) for w in words]
        hit = [i for i, (a, b) in enumerate(zip(words, now)) if len(a) != len(b)]
        assert which.tolist() == hit
        assert flat.tolist() == [x for i in hit for x in now[i]] and size.tolist() == [len(now[i]) for i in hit]


@pytest.mark.parametrize("wide", [0, 4, 10**9])
def test_rounds_in_place_and_on_layers_learn_the_same(spark, monkeypatch, wide):
    """rounds that rewrite many words shuffle no word; both ways equal the library."""
    from quire.operators import bpe_train as bt

    monkeypatch.setattr(bt, "WIDE", wide)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    lib = [tuple(x) for x in json.loads(_library(80, texts).to_str())["model"]["merges"]]
    words = spark.createDataFrame([(w, 1) for w in texts], "word string, count long").groupBy("word").agg({"count": "sum"}).toDF("word", "count")
    plans = []
    found = bt.TrainingTables.words_with
    monkeypatch.setattr(bt.TrainingTables, "words_with", lambda self, keys: plans.append(found(self, keys)) or plans[-1])
    assert bt.train_bpe(spark, words, 80, 2, hot=16, chains=200).merges == lib
    moved = ["Exchange" in p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert not moved[0] and (wide == 10**9) == (not any(moved))


def test_links_are_chosen_in_one_look(spark):
    from quire.operators import bpe_train as bt

    pairs = [(a, b) for a in range(8) for b in range(8)]
    rows = [([a, b, a], 1) for a, b in pairs for _ in range(2)]
    words = spark.createDataFrame(rows, "sym array<int>, count long").repartition(3)
    ranked = [a << bt.SHIFT | b for a, b in pairs]
    for links, chains in ((64, 100), (64, 40), (64, 9), (33, 20), (64, 1)):
        chosen = bt._most_links(words, ranked, links, chains)
        import numpy as np

        n = lambda x: bt._chains(words, np.sort(np.array(ranked[:x], "i8"))).count()
        assert chosen == next((x for x in (links >> i for i in range(links.bit_length())) if n(x) <= chains), 1)


def test_encoding_through_a_dictionary(spark):
    lib = _library(200)
    model = train_bpe(spark, vb.word_counts(spark.createDataFrame([(t,) for t in TEXTS], "t string").select(vb.pretokenize("t").alias("p")), "p"), 200, 2)
    texts = TEXTS[:5] + ["x  <eos>  y<eos><bos> z", "!!<eos>", " <eos> ", "<eo<eos>s>", "'s<eos>'s 9<unk>9", "", None, "the " * 3000, "a" * 3000, "\x00 new \u3000 blank\u2028s  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(3, texts[3])], "doc_id long, text string").repartition(4)
    tok = be.BPETokenizer(model)
    for frequent in (0, 10, 10_000):
        got = be.encode_documents(df, tok, frequent=frequent).collect()
        assert len(got) == len(texts) + 1
        for r in got:
            assert r.ids is None if r.text is None else list(r.ids) == lib.encode(r.text).ids
    back = df.select("text", tok.encode("text").alias("ids")).select("text", "ids", tok.decode("ids").alias("d"), tok.decode("ids", False).alias("all"))
    for r in back.collect():
        want = None if r.text is None else lib.encode(r.text).ids
        assert r.ids == want
        assert r.d == (None if want is None else lib.decode(want)) and r.all == (None if want is None else lib.decode(want, skip_special_tokens=False))
    assert be.encode_documents(df.where("doc_id < 0"), tok).count() == 0


def test_encoding_shuffles_no_text_and_encodes_once(spark):
    """F8: only the counted pieces move; several uses of the ids share one encoding."""
    model = vb.BPEModel([*vb.SPECIAL_TOKENS, *vb.byte_to_unicode()])
    tok = be.BPETokenizer(model)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    coded = be.encode_documents(df, tok, frequent=5)
    used = coded.select("doc_id", F.size("ids").alias("n"), tok.decode("ids").alias("back"))
    plan = used._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("enc(") == 1
    assert {r.doc_id: r.back for r in used.collect()} == dict(enumerate(TEXTS))


def test_long_batches_are_encoded_in_blocks(monkeypatch):
    import pyarrow as pa

    lists = pa.array([["a"], [], None, ["b", "c", "d"], ["e"], ["a", "b"]]).slice(1)
    one = be.encode_pieces(lists, lambda p: [ord(p)] * 2, (1, 2))
    monkeypatch.setattr(be, "BLOCK", 2)
    assert be.encode_pieces(lists, lambda p: [ord(p)] * 2, (1, 2)).to_pylist() == one.to_pylist()
    assert one.to_pylist()[:3] == [[1, 2], None, [1, 98, 98, 99, 99, 100, 100, 2]]
    assert be.encode_pieces(lists.slice(0, 0), ord, None).to_pylist() == []


def test_pretokenize_is_lossless_and_matches_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import pre_tokenizers

    pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    b2u = vb.byte_to_unicode()
    df = spark.createDataFrame([(t,) for t in TEXTS[:5]], "t string").select("t", vb.pretokenize("t").alias("p"))
    for r in df.collect():
        assert "".join(r.p) == r.t
        ours = ["".join(b2u[b] for b in piece.encode("utf-8")) for piece in r.p]
        assert ours == [w for w, _ in pre.pre_tokenize_str(r.t)]


def test_byte_tokenizer_round_trip(spark):
    bt = ByteTokenizer()
    vals = ["héllo", "", None, "a<eos>"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    rows = df.select(bt.encode("t").alias("ids"), bt.encode("t", template=False).alias("plain"), bt.count("t").alias("n")).collect()
    assert list(rows[0].ids) == [1] + [b + 4 for b in "héllo".encode()] + [2]
    assert list(rows[1].ids) == [1, 2] and rows[2].ids is None
    assert rows[0].n == len(rows[0].ids)
    back = df.select(bt.decode(bt.encode("t")).alias("d")).collect()
    assert [r.d for r in back] == ["héllo", "", None, "a<eos>"]


def test_sample_documents_quota(spark):
    from quire.config import DataMixConfig, SourceConfig

    mix = DataMixConfig(sources=[SourceConfig(name="a", weight=3.0), SourceConfig(name="b", weight=1.0, sample_documents=2)])
    rows = [("a", i, "t") for i in range(10)] + [("b", 100 + i, "t") for i in range(10)]
    df = spark.createDataFrame(rows, "source string, doc_id long, text string")
    got = {r.source: r["count"] for r in vb.sample_documents(df, spark, mix, 4, seed=1).groupBy("source").count().collect()}
    assert got == {"a": 3, "b": 2}


def test_sample_without_ranks_is_the_ranked_sample(spark):
    """F8: the same documents (as many of those that share the last id), texts not shuffled."""
    from quire.config import DataMixConfig, SourceConfig

    mix = DataMixConfig(sources=[SourceConfig(name="a", weight=3.0), SourceConfig(name="b", weight=1.0), SourceConfig(name="c", weight=1.0)])
    rows = [("a", i, f"t{i}") for i in range(40)] + [("b", i % 3 or None, f"t{i}") for i in range(20)] + [(None, 1, "t"), ("d", 1, "t"), ("c", 5, "t")]
    df = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(3)
    for total in (10, 33, 60, 500):
        ranked = vb.sample_documents(df, spark, mix, total, seed=1)
        got = vb.sample_documents(df, spark, mix, total, seed=1, ranked=False)
        assert got.columns == df.columns
        keys = lambda d: sorted((r.source, r.doc_id or -1) for r in d.collect())
        assert keys(got) == keys(ranked)
        assert len({tuple(r) for r in got.collect()}) == got.count()
    unique = spark.createDataFrame(rows[:40], "source string, doc_id long, text string")
    plan = vb.sample_documents(unique, spark, mix, 20, seed=1, ranked=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_byte_decode_handles_truncated_utf8(spark):
    bt = ByteTokenizer()
    df = spark.createDataFrame([([1, 4 + 0xC3, 2],), ([1, 4 + ord("a"), 2],), (None,)], "ids array<int>")
    assert [r.t for r in df.select(bt.decode("ids").alias("t")).collect()] == ["�", "a", None]
