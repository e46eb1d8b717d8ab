"""What the optimizer makes of the queries: no Python rows, no blind pairing, narrow scans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from tablewright.plans import feature_queries, genotype_queries, metric_queries, relational_queries, sampling_queries, views

QUERIES = entry.queries()

RELATIONAL = [
    name
    for name, fn in QUERIES.items()
    if fn.__module__ in {m.__name__ for m in (relational_queries, sampling_queries)}
]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_python_and_no_cartesian(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroups", plan)
    if name != "cross_join":
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_the_needed_columns(spark, small):
    plan = plan_of(QUERIES["rating_stats_by_item"](spark, small))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<p_partkey:bigint,p_name:string>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint>" in schemas
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas


def test_filters_reach_the_scan(spark, small):
    plan = plan_of(views.priced_lines(spark, small).where("l_quantity > 45"))
    assert "GreaterThan(l_quantity,45.0)" in plan


def test_documents_text_is_not_read_for_labels(spark, small):
    assert "text" not in "".join(re.findall(r"ReadSchema: (struct<[^>]*>)", plan_of(QUERIES["attach_labels"](spark, small))))


def test_top_k_does_not_sort_everything(spark, small):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["most_active_users"](spark, small))


def test_suppliers_meet_aggregated_lines(spark, small):
    plan = plan_of(views.genotype(spark, small))
    assert plan.index("Join [l_suppkey") < plan.index("Join [l_partkey")
    between = plan[plan.index("Join [l_suppkey"):plan.index("Join [l_partkey")]
    assert "HashAggregate(keys=[l_suppkey" in between


@pytest.mark.parametrize("module", [feature_queries, genotype_queries, metric_queries])
def test_no_forced_broadcast(module):
    assert "broadcast(" not in open(module.__file__).read()


def test_scratch_follows_the_session(spark):
    from tablewright.workspace import CHECKPOINT_KEY, scratch_root

    base = spark.conf.get(CHECKPOINT_KEY, None)
    if base is not None:
        assert scratch_root(spark).startswith(base)
