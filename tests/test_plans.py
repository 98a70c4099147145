"""The scale design as plan properties of the registered queries (sf0.001)."""

import pytest

from wikipassages.plans import catalog
from wikipassages.plans.corpus import corpus_xml
from wikipassages.plans.primary import run_primary_records

from conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_or_nested_loop_joins_and_no_row_udfs(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_redirect_counts_are_pre_aggregated_before_the_shuffle(spark):
    plan = _plan(run_primary_records(corpus_xml(spark, SMALL)).redirected)
    partial = plan.index("partial_count(1)")
    exchange = plan.rfind("Exchange hashpartitioning(key", 0, partial)
    assert exchange != -1          # the exchange sits above (before, in the text) the partial count


def test_top_k_uses_a_partial_group_limit(spark):
    assert "WindowGroupLimit" in _plan(catalog.QUERIES["search_tfidf"](spark, SMALL))
