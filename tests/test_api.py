"""Public API paths: configs, config-driven scans, chat format registry, options."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quire.config import ChatConfig, DataMixConfig, SourceConfig, read_chat, read_mix, read_source, val_shard_size
from quire.operators import chat as ch
from quire.operators import mixture as mx
from quire.sources.corpus import clean_corpus, scan_corpus


def test_configs_are_strict_and_accept_published_layouts():
    mix = read_mix({
        "train_tokens": 100, "val_tokens": 10, "shard_size_tokens": 50,
        "sources": [{"name": "a", "path": "p", "split": "train", "text_field": "content", "weight": 0.6, "shuffle_buffer": 5}],
    })
    assert mix.sources[0].text_field == "content" and val_shard_size(mix) == 1_000_000
    with pytest.raises(TypeError):
        read_mix({"sources": [], "bogus": 1})
    with pytest.raises(TypeError):
        read_source({"name": "a", "colour": "red"})
    single = read_chat({"path": "hf/ds", "split": "train", "format": "alpaca", "val_examples": 3})
    assert single.sources[0].path == "hf/ds" and single.format == "alpaca"
    multi = read_chat({"sources": [{"source_name": "s", "path": "x", "weight": 0.5, "row_filters": {"quality": "good"}}]})
    assert multi.sources[0].row_filters == {"quality": "good"}


def test_scan_corpus_projects_text_field_and_skips_non_strings(spark):
    d = tempfile.mkdtemp(prefix="quire-test-", dir="/tmp")
    spark.createDataFrame([(1, "  hello "), (2, "   ")], "id long, content string").write.parquet(f"{d}/a")
    spark.createDataFrame([(3, 7)], "id long, text int").write.parquet(f"{d}/b")
    mix = DataMixConfig(sources=[
        SourceConfig(name="a", path=d, data_dir="a", text_field="content"),
        SourceConfig(name="b", path=f"{d}/b", text_field="text"),
    ])
    docs = scan_corpus(spark, mix)
    rows = clean_corpus(docs).collect()
    assert [(r.source, r.text) for r in rows] == [("a", "hello")]
    assert docs.where(F.col("source") == "b").first().text is None
    assert rows[0].doc_id is not None  # content hash id when no id field is given


def test_custom_chat_format_and_header_masking(spark):
    ch.register_chat_format("qa_pair", lambda c: ch.normalize_prompt_response("q", "a"))
    df = spark.createDataFrame([("hi", "yo")], "q string, a string")
    msgs = ch.to_messages(df, ChatConfig(format="qa_pair"))
    row = msgs.select(ch.mask_labels("messages", label_alignment="same_position", supervise_header=False).alias("p")).first().p
    header = [b + 4 for b in "<|assistant|>\n".encode()]
    body = [b + 4 for b in "yo\n".encode()]
    user = [b + 4 for b in "<|user|>\nhi\n".encode()]
    assert list(row.input_ids) == [1] + user + header + body + [2]
    assert list(row.labels) == [-100] * (1 + len(user) + len(header)) + body + [2]
    with pytest.raises(ValueError):
        ch.to_messages(df, ChatConfig(format="nope"))


def test_mix_report_keeps_unused_sources(spark):
    docs = spark.createDataFrame([("a", 1, 5), ("a", 2, 5)], "source string, doc_id long, n_tokens long")
    tg = spark.createDataFrame([("a", 6, 2), ("z", 3, 0)], "source string, train_target long, val_target long")
    rep = {r.source: r for r in mx.mix_report(mx.plan_mixture(docs, tg), tg).collect()}
    assert rep["z"].documents_used == 0 and rep["z"].train_tokens_written == 0
    assert rep["a"].val_tokens_written == 2 and rep["a"].train_tokens_written == 5


def _folder(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "text string").coalesce(1).write.mode("overwrite").parquet(path)


def test_split_config_and_revision_are_resolved_or_refused(spark, tmp_path):
    import pytest

    from quire.config import ChatSourceConfig, SourceConfig
    from quire.sources.chat import scan_chat
    from quire.sources.corpus import scan_source

    base = str(tmp_path / "data")
    _folder(spark, f"{base}/v2/code/train", ["a", "b"])
    _folder(spark, f"{base}/v2/code/validation", ["c"])
    read = lambda **kw: sorted(r.text for r in scan_source(spark, SourceConfig(name="s", path=base, **kw)).collect())
    assert read(revision="v2", config_name="code", split="validation") == ["c"]
    assert read(revision="v2", data_dir="code", split="train") == ["a", "b"]
    for wrong in ({"revision": "v3"}, {"config_name": "prose"}, {"revision": "v2", "config_name": "code", "split": "test"}):
        with pytest.raises(ValueError, match="not found"):
            read(**wrong)
    chat = ChatSourceConfig(source_name="c", path=f"{base}/v2", config_name="code", split="validation")
    assert [r.text for r in scan_chat(spark, chat).collect()] == ["c"]
    with pytest.raises(ValueError, match="not found"):
        scan_chat(spark, ChatSourceConfig(source_name="c", path=f"{base}/v2/code/train", split="validation"))


def test_equal_texts_keep_distinct_ids(spark, tmp_path):
    import pytest

    from quire.config import SourceConfig
    from quire.sources.corpus import scan_source

    _folder(spark, str(tmp_path / "t"), ["same"] * 50 + ["other"])
    docs = scan_source(spark, SourceConfig(name="s", path=str(tmp_path / "t")))
    assert docs.select("doc_id").distinct().count() == 51
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in docs.repartition(7).collect())
    spark.createDataFrame([("x",)], "text string").write.json(str(tmp_path / "j"))
    with pytest.raises(ValueError, match="id field"):
        scan_source(spark, SourceConfig(name="s", path=str(tmp_path / "j"), format="json"))


def test_no_local_scratch_on_a_cluster(monkeypatch):
    import pytest

    from quire import session

    class Conf:
        def get(self, key, default=None):
            return "spark://host:1" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
