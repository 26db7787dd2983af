"""Physical-plan checks over every registered query."""

import pytest

from quire.workloads import registry
from tests.conftest import SF_SMALL

QS = registry.queries()
HEAVY = {"train_bpe", "encode_bpe"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QS) - HEAVY))
def test_no_pairwise_joins(spark, name):
    plan = _plan(QS[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_row_filters_and_pruning_reach_the_scan(spark):
    plan = _plan(QS["chain_sources"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,src0)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan
    scan = _plan(QS["word_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in scan


def test_rank_filter_is_a_group_limit(spark):
    assert "WindowGroupLimit" in _plan(QS["cap_samples"](spark, SF_SMALL))
