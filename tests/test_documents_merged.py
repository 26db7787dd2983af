"""Merged result documents and messages of mixed content against hand-written values."""

import json

from pyspark.sql import functions as F

from quire.operators import chat as ch
from quire.sources import eval_documents as ed

FILES = {
    "m1/results_1.json": {
        "config_general": {"model_name": "m1", "lighteval_sha": "abc", "nested": {"seed": [1, 2, {"x": None}]}},
        "results": {"mmlu:a|0": {"acc": 0.5, "acc_stderr": 0.1, "f1": {"macro": 0.25}}, "all": {"acc": 0.9}, "qa|0": {"em": 0.75}, "odd \"key\"|0": {"acc": 1}},
        "config_tasks": {"mmlu:a": {"hf_repo": "r", "metrics": ["acc"]}},
        "summary_tasks": {"mmlu:a|0": {"hashes": {"h": "1"}}},
        "summary_general": {"hashes": {"all": "z"}, "took": 1},
        "versions": {"mmlu:a|0": 0, "qa|0": 3},
    },
    "m1/deep/results_2.json": {
        "config_general": {"model_name": "other"},
        "results": {"mmlu:a|0": {"acc": 0.75}, "mmlu:b|0": {"acc": 0.25}},
        "config_tasks": {"mmlu:a": {"hf_repo": "late"}, "mmlu:b": {"hf_repo": "r2"}},
        "versions": {"mmlu:a|0": "1.1", "mmlu:b|0": 2},
        "unknown": {"left": "out"},
    },
    "m2/results_x.json": {"results": {"only|0": {"em": 2}}, "versions": None, "config_tasks": [1]},
    "m3/results_bad.json": None,
}


def test_documents_merge_to_the_expected_one(spark, tmp_path):
    for name, doc in FILES.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("{broken" if doc is None else json.dumps(doc, indent=1))
    out = ed.merge_result_files(spark, str(tmp_path / "in"), group_depth=1)
    got = {r.group: json.loads(r.document) for r in out.collect()}
    # "deep/results_2.json" comes before "results_1.json" in path order.
    stderr = (0.1**2 / 3) ** 0.5
    assert set(got) == {"m1", "m2"}
    results = got["m1"].pop("results")
    assert results.pop("all")["acc"] == (0.75 + 0.25 + 1) / 3
    assert results.pop("mmlu|0") == {"acc": 0.5, "acc_stderr": 0.0}
    assert results == {"mmlu:a|0": {"acc": 0.75}, "mmlu:b|0": {"acc": 0.25}, "qa|0": {"em": 0.75}, 'odd "key"|0': {"acc": 1}}
    assert got["m1"] == {
        "config_general": {"model_name": "other"},
        "config_tasks": {"mmlu:a": {"hf_repo": "late"}, "mmlu:b": {"hf_repo": "r2"}},
        "summary_tasks": {"mmlu:a|0": {"hashes": {"h": "1"}}},
        "summary_general": {},
        "versions": {"mmlu:a|0": 0, "qa|0": 3, "mmlu:b|0": 2},
    }
    assert got["m2"] == {"config_general": {}, "results": {"only|0": {"em": 2}}, "config_tasks": {}, "summary_tasks": {}, "summary_general": {}, "versions": {}}

    one = json.loads(ed.merge_result_files(spark, str(tmp_path / "in" / "m1" ), 0).first().document)
    assert one["results"]["mmlu:a|0"] == {"acc": 0.75}
    alone = ed.read_documents(spark, str(tmp_path / "in")).where("file = 'm1/results_1.json'")
    doc = json.loads(ed.merged_documents(ed.merge_entries(ed.entries(alone))).first().document)
    assert doc["config_general"] == FILES["m1/results_1.json"]["config_general"] and doc["summary_general"]["took"] == 1
    assert abs(doc["results"]["all"]["acc_stderr"] - (0.1**2 / 2) ** 0.5) < 1e-15 and stderr > 0
    assert doc["results"]["mmlu:a|0"] == {"acc": 0.5, "acc_stderr": 0.1, "f1": {"macro": 0.25}}

    ed.write_documents(out, str(tmp_path / "out"))
    back = {r.group: json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert back["m2"] == got["m2"] and set(back) == {"m1", "m2"}


def test_strings_and_parts_in_one_column(spark):
    rows = [
        [{"role": "user", "content": " hi "}, {"role": "assistant", "content": [{"text": "a"}, {"text": ""}, {"type": "image"}, "loose", {"text": "b "}]}],
        [{"role": 5, "content": "x"}, {"content": "x"}, "loose", {"role": "user", "content": {"text": "x"}}, {"role": "user", "content": None}, {"role": "user", "content": "5"}],
        [{"role": "user", "content": []}, {"role": "user", "content": [{"text": 7}, {"text": None}]}, {"role": "user", "content": 7}],
        [],
        {"role": "user", "content": "no list"},
        None,
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)] + [(9, None), (10, "{bad")], "i int, s string")
    out = df.select("i", ch.normalize_mixed_messages(F.try_parse_json("s")).alias("m"))
    got = {r.i: None if r.m is None else [tuple(x) for x in r.m] for r in out.collect()}
    assert got == {0: [("user", "hi"), ("assistant", "a\nb")], 1: [("user", "5")], 2: [], 3: [], 4: None, 5: None, 9: None, 10: None}
