"""Registered queries against their DuckDB SQL on the smallest tables."""

import pytest

from quire.llm.queries import QUERIES, SQL
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows, _same


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _same(_rows(df.columns, got), _rows(rel.columns, rel.fetchall()))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_runs_over_every_row(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
