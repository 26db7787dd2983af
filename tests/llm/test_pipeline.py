"""The pipeline on the smallest table: every stage against what it should have done."""

from collections import Counter

import corpus_pipeline as pipe
from quire.llm.batches import table
from quire.plans.materialize import checkpointed
from tests.conftest import SF_SMALL
from tests.llm.test_documents import brute_cut, fingerprint, groups, words


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    labels = {r.doc_id: r for r in table(spark, SF_SMALL, "labels").collect()}
    seen = [docs]
    for name, stage in pipe.STAGES[:-1]:
        after = checkpointed(stage(spark, seen[-1], SF_SMALL), name)
        assert after.dtypes == docs.dtypes
        seen.append(after)
    rows = [{r.doc_id: r for r in s.collect()} for s in seen]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))
    good = [i for i in rows[0] if i in labels and labels[i].quality == 1]
    assert sum(i in rows[1] for i in good) >= 0.95 * len(good)
    clean = [i for i in rows[1] if i in labels and labels[i].toxic == 0]
    assert sum(i in rows[2] for i in clean) >= 0.98 * len(clean)
    ids = sorted(rows[2])
    fps = [fingerprint(rows[2][i].text) for i in ids]
    root = groups(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3])
    assert set(rows[3]) == {ids[g] for g in set(root)}
    want = {i: n for i, _, n, _ in brute_cut([(i, r.text) for i, r in rows[3].items()], 50)}
    for i, r in rows[4].items():
        assert len(words(rows[3][i].text)) - len(words(r.text)) == want[i]
        assert r.text == rows[3][i].text if not want[i] else r.n_chars == len(r.text)


def test_run_packs_every_kept_document(spark):
    pieces = pipe.run(spark, SF_SMALL).collect()
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id] += r.length
    assert tokens and all(tokens[r.doc_id] == r.doc_tokens for r in pieces)
    assert [n for n, _ in pipe.STAGES] == ["quality", "toxicity", "simhash_near_dedup", "substring_dedup", "packing"]
