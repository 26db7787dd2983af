"""Every SQL-checkable workload equals its DuckDB oracle (on sf0.001 for speed)."""

import math

import pytest

import __spark_entry__ as entry
from quire.workloads import registry
from tests.conftest import SF_SMALL

QS = registry.queries()
SQL = registry.oracle_sql()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    if isinstance(v, int):
        return (2, float(v))
    return (6, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def _same(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for (ka, va), (kb, vb) in zip(ra, rb):
            if ka != kb:
                return False
            if ka == 2 and not math.isclose(va, vb, rel_tol=1e-9, abs_tol=1e-12):
                return False
            if ka != 2 and va != vb:
                return False
    return True


def test_every_query_has_sql_or_is_rows_only():
    rows_only = set(QS) - set(SQL)
    assert rows_only == {"encode_bpe", "train_bpe"}
    assert set(SQL) <= set(QS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QS[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _same(_rows(df.columns, got), _rows(rel.columns, rel.fetchall()))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert set(df.columns) >= {"source", "train_target_tokens", "train_tokens_written", "documents_used"}
