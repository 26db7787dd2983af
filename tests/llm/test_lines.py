"""Line dedup by levelled runs against a plain statement of its contract."""

import hashlib
import random
from collections import defaultdict

import pytest

from quire.llm.line_runs import LineRuns, dedup_lines, line_hashes
from tests.llm.conftest import DOCS

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip("\t\n\x0b\x0c\r ").translate(ASCII)


def brute(rows, min_chars=20, min_docs=3):
    """``rows``: (doc_id, text). A null id is one document below all others."""
    low = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders[key_of(line)].add(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key_of(x), ())) < min_docs or max(holders[key_of(x)]) == low(i)]
        out.append((low(i), len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


def lined(n=220, seed=2):
    rng = random.Random(seed)
    common = ["Subscribe to our newsletter today!", "ALL RIGHTS RESERVED, everywhere", "Élan vital ÉTÉ comme d'habitude", "élan vital ÉTÉ comme d'habitude", "short line"]
    common += ["x" * 19, "y" * 20, "漢字" * 10, "tab\tinside of this line here", "Kelvin sign is not the letter k", "kelvin sign is not the letter k"]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rng.randint(0, 9)):
            x = rng.choice(common) if rng.random() < 0.6 else f"own line {rng.randint(0, 4 * n)} of its document"
            x = x.upper() if rng.random() < 0.2 and x.isascii() else x
            lines.append(rng.choice(["", " ", "\t \x0b", "\r"]) + x + rng.choice(["", "  ", "\x0c", "\r"]))
        rows.append((rng.randint(-n, 2 * n), "\n".join(lines) + rng.choice(["", "\n"])))
    rows += [(None, "\n".join(common)), (None, "\n".join(common)), (5, None), (6, ""), (7, "\n\n"), (8, " " * 25), (9, " " * 25), (10, " " * 25)]
    return rows + rows[:12] + [(rows[0][0], rows[30][1])]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (7, 3)])
def test_lines_match_brute_force(spark, batches, fanout):
    rows = lined()
    df = spark.createDataFrame([(i, t, "h1", 1, 2) for i, t in rows], "doc_id long, text string, h1 string, place int, gone int").repartition(6)
    assert result(dedup_lines(df, batches=batches, fanout=fanout)) == brute(rows)
    assert brute(rows) != brute(rows, min_docs=10**6)


def test_odd_documents(spark, edge_docs, edge_rows, no_docs):
    assert result(dedup_lines(edge_docs, min_chars=1, min_docs=2, batches=3)) == brute([(r[0], r[1]) for r in edge_rows], 1, 2)
    assert dedup_lines(no_docs).count() == 0
    assert result(dedup_lines(spark.createDataFrame([(None, "a line of more than twenty")] * 4, "doc_id long, text string"))) == brute([(None, "a line of more than twenty")] * 4)


def test_one_hot_line_and_one_hot_row(spark):
    hot = "this line is in every third document"
    rows = [(i, f"{hot}\nown line number {i} here it is" if i % 3 == 0 else f"only line number {i} of it") for i in range(900)] + [(4000, f"{hot}\n{hot}")] * 50
    got = result(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == brute(rows)
    assert sum(r[2] for r in got) == 300


def test_levels_stay_few_and_settled_keys_are_not_added_again(spark):
    docs = lambda ids: spark.createDataFrame([(i, f"a line that all of them hold\nline of document {i} alone") for i in ids], "doc_id long, text string")
    runs = LineRuns(spark, min_docs=3, fanout=3)
    for b in range(7):
        runs.add(line_hashes(docs(range(100 - 5 * b, 95 - 5 * b, -1)), 20))
        assert all(len(level) < 3 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [1, 2]
    last = spark.table(runs.levels[0][0])
    assert last.count() == 5  # the shared key is settled in an older run
    a, b = (spark.table(name) for name in runs.levels[1])
    for how in ("full", "left_anti"):
        plan = a.join(b.hint("merge"), ["h1", "h2"], how)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert [(r.keeper) for r in runs.frequent().collect()] == [100]
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("quire_line_run_")]


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a")], DOCS.split(", lang")[0])
    plan = dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
