"""Classifiers: held-out accuracy on the given tables, pieces against plain statements."""

import random

import numpy as np
import pytest

from quire.llm.batches import table, without_rows
from quire.llm.site_bayes import Logistic, _strength, classify, url_site
from quire.llm.toxicity_gbt import FEATURES, Reader, Trees, all_term_counts, isotonic, score_toxicity, undisguised
from tests.conftest import SF_MID


def held_out(found, truth, label):
    rows = found.join(truth.select("doc_id", label), "doc_id").where("held_out").toPandas()
    return rows, rows[label].to_numpy()


def area(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality_on_held_out_rows(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    found = classify(docs, labels)
    rows, y = held_out(found, labels, "quality")
    assert (rows["kept"].to_numpy() == (y == 1)).mean() > 0.95
    assert found.count() == docs.count()
    assert sorted(found.columns) == sorted(["doc_id", "text_key", "held_out", "evidence", "host_mean", "site_mean", "score", "kept"])


def test_toxicity_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows, y = held_out(score_toxicity(docs, labels), labels, "toxic")
    assert area(rows["score"].to_numpy(), y) > 0.95
    assert ((rows["predicted"] == 1) & (y == 0)).sum() <= 0.01 * len(y)
    assert ((rows["predicted"] == 1) & (y == 1)).sum() >= 0.7 * y.sum()
    assert rows["score"].between(0, 1).all()


@pytest.mark.parametrize("job", [classify, score_toxicity])
def test_odd_rows(spark, job, edge_docs, edge_rows, labels, no_docs):
    out = job(edge_docs, labels).collect()
    assert len(out) == len(edge_rows) and all(0 <= r.score <= 1 for r in out)
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == sorted(r[0] for r in edge_rows if r[0] is not None)
    nothing = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in job(edge_docs, nothing).collect())
    assert job(no_docs, labels).count() == 0


def test_sparse_sites_shrink_to_their_parents(spark):
    """Two documents with the same text differ only by their site; a large bad site weighs
    more than a site of one."""
    good, bad = "the plain words of a good text. " * 9, "X% X% |X| " * 9
    rows = [(i, good if i % 2 else bad, "host", "p", i) for i in range(40)]
    rows += [(100 + i, bad, "poor", "p", 0) for i in range(60)] + [(200, good, "poor", "p", 0), (201, good, "new", "p", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, site int")
    truth = spark.createDataFrame([(r[0], int(r[1] == good)) for r in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in classify(docs, truth).collect()}
    assert got[200].site_mean < got[201].site_mean
    assert got[200].score < got[201].score and got[201].kept and got[200].evidence == got[201].evidence


def test_prior_strength_by_moments():
    assert _strength(0.5, 0.1, 0.05) == 1e6  # no spread beyond chance: one shared mean
    assert abs(_strength(0.5, 0.0, 0.05) - 4.0) < 1e-9
    assert _strength(0.5, 0.0, 10.0) == 1.0


def test_logistic_separates_and_keeps_its_prior():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.3 * rng.normal(size=400) > 0).astype(float)
    m = Logistic(x, y)
    assert ((m.probability(x) > 0.5) == y).mean() > 0.9 and abs(m.probability(x).mean() - y.mean()) < 0.01


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    t = Trees(x[:1000], y[:1000])
    assert ((t.margin(x[1000:]) > 0) == y[1000:]).mean() > 0.95


def test_isotonic_is_monotone_and_pools_violators():
    at, share = isotonic(np.array([1.0, 2, 3, 4, 5, 6]), np.array([0.0, 1, 0, 1, 1, 1]))
    assert (np.diff(share) >= 0).all() and len(at) < 6 and share[0] < share[-1]


def test_disguised_words_are_read():
    assert undisguised(b"1d10t") == b"idiot" and undisguised(b"i.d.i-o_t") == b"idiot" and undisguised(b"loooooser") == b"looser"
    reader = Reader({b"idiot": 5.0, b"lowe*": 4.0, b"meh": 2.0}, 3.0)
    plain, hidden = reader.features(b"you are an idiot, meh Loweitum"), reader.features(b"you 1d10t")
    assert plain[1] == np.log1p(2) and plain[4] == np.log1p(1) and plain[8] > 0 and plain[6] == 0 and hidden[6] > 0


def test_url_site(spark):
    df = spark.createDataFrame([("http://A.example/b/c?d", ), (None,), ("nonsense",)], "url string")
    host, path = url_site(df["url"])
    got = [tuple(r) for r in df.select(host, path).collect()]
    assert got[0] == ("a.example", "b") and got[1] == (None, None)


def test_rejected_rows_go_by_id_and_text(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, None, 3), (None, "a", 4)], "doc_id long, text string, x int")
    gone = df.where("x in (2, 3)").selectExpr("doc_id", "xxhash64(text) AS text_key")
    assert sorted(r.x for r in without_rows(df, gone).collect()) == [1, 4]


def test_lexicon_counts_texts_beyond_the_sample(spark):
    """A toxic word that is too rare for the sample of the trees still enters the lexicon."""
    rng = np.random.default_rng(4)
    common, plain = ["zonkard", "vilewit"], [f"w{i}" for i in range(300)]
    rows = []
    for i in range(4000):
        words = list(rng.choice(plain, 12)) + [f"n{i}"]
        toxic = i % 4 == 0
        if toxic:
            words.insert(3, "qwxrare" if i % 80 == 0 else common[i % 8 // 4])
        rows.append((i, " ".join(words), int(toxic)))
    rows += [(9000 + i, " ".join([*rng.choice(plain, 12), "qwxrare"]), 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    truth = docs.where("doc_id < 9000").select("doc_id", "toxic")
    got = {r.doc_id: r.score for r in score_toxicity(docs, truth, sample=200).collect()}
    clean = np.mean([got[r[0]] for r in rows if not r[2]])
    assert min(got[9000 + i] for i in range(20)) > clean + 0.3


@pytest.mark.parametrize("ids_a_pass", [16, 1000])
def test_term_counts_are_of_distinct_texts(spark, ids_a_pass):
    texts = [(i, f"common t{i % 7} {'bad' if i % 3 == 0 else 'good'}", int(i % 3 == 0)) for i in range(42)]
    docs = spark.createDataFrame([*texts, *[texts[0]] * 2, *[texts[5]] * 4], "doc_id long, text string, label int")
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS text_key", "label")
    rows = keyed.groupBy("doc_id", "text_key", "label").count().withColumnRenamed("count", "n")
    got = {bytes(r.term): (r.toxic, r.clean) for r in all_term_counts(keyed.drop("label"), rows, ids_a_pass).collect()}
    whole = {(t, y) for _, t, y in texts}
    for word in ("common", "bad", "good", "t0", "t5"):
        assert got[word.encode()] == tuple(sum(word in t.split() for t, y in whole if y == label) for label in (1, 0))


def test_features_count_all_signs():
    reader = Reader({b"idiot": 5.0, b"meh": 2.0}, 3.0)
    f = lambda text: dict(zip(FEATURES, reader.features(text.encode())))
    assert f("BRVWZ br")["capitals"] == 5 / 7 and f("ÄÖÜ ДУ ä")["capitals"] == 5 / 6
    assert f("ДУРАК so")["shouted_words"] == 0.5
    assert f("a (b) [c] \"d\" <e> f:g")["marks"] == 9 / 6
    assert f("5h1t b7d8")["signs_in_words"] == 4 / 9 and f("f_u~c^k m%n&o")["signs_in_words"] == 5 / 13
    assert f("i.d-i'o! Well. ")["signs_in_words"] == 3 / 15
    assert f("nothing but you")["second_person"] == 1 / 3
    weak = f("you meh a b c d e f g meh")
    assert weak["second_person"] == weak["near_second_person"] == 0.1


def test_own_evidence_is_left_out_of_host_and_path(spark):
    """Posteriors against a plain statement; a document alone on its host has the global mean."""
    from quire.llm.site_bayes import classify

    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["fine words", "here. And", "#|#|#", "MORE 123"]) for _ in range(rng.randint(1, 40))), f"p{i % 3}", f"h{i % 7}" if i < 80 else f"only{i}") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame([(i, int(t.count("#") < 4)) for i, t, *_ in rows], "doc_id long, quality int")
    got = {r.doc_id: r for r in classify(docs, marks).collect()}
    p = {i: r.evidence for i, r in got.items()}
    mean = sum(p.values()) / len(p)
    host = {i: h for i, _, _, h in rows}
    on = lambda i: [j for j in p if host[j] == host[i] and j != i]
    for i in range(80, 90):
        assert abs(got[i].host_mean - mean) < 1e-9
    # One strength explains every host's posterior: solve it from one document, use it on all.
    k = sum(p[j] for j in on(0))
    strength = (k - got[0].host_mean * len(on(0))) / (got[0].host_mean - mean)
    for i in p:
        want = (sum(p[j] for j in on(i)) + strength * mean) / (len(on(i)) + strength)
        assert abs(got[i].host_mean - want) < 1e-6
