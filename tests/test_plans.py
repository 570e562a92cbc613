"""Plan shape: join types, pushdown, pruning, no Python in the hot path."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from martwright import registry


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sales_lines_only_invoice_join_is_outer(spark):
    plan = _optimized(registry.queries()["sales_lines"](spark, SF_SMALL))
    assert plan.count("LeftOuter") == 1
    assert plan.count("Inner") == 3


def test_transactions_outer_joins_are_the_optional_tail(spark):
    plan = _optimized(registry.queries()["transactions"](spark, SF_SMALL))
    # invoice->customer, customer->nation, nation->region (staging), lines->invoices
    assert plan.count("LeftOuter") == 4
    assert plan.count("Inner") == 1


def test_filters_and_pruning_reach_the_scan(spark):
    plan = _physical(registry.queries()["sales_lines"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_suppkey)]" in plan
    # the line scan reads only the five columns it needs
    assert ("ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int,"
            "l_quantity:double,l_extendedprice:double>") in plan


def test_mart_reads_only_needed_columns(spark):
    plan = _physical(registry.queries()["visit_frequency"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_evaluation(spark, name):
    plan = _physical(registry.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF"):
        assert node not in plan, node


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = _physical(registry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_aggregates_are_partial_then_final(spark):
    plan = _physical(registry.queries()["artist_revenue"](spark, SF_SMALL))
    assert "partial_sum" in plan


def test_line_marts_share_one_scan(spark, tmp_path):
    from martwright.plans import marts

    lines = registry.queries()["sales_lines"](spark, SF_SMALL)
    path = str(tmp_path / "sales_lines")
    lines.write.parquet(path)
    totals = marts.sales_line_totals(spark.read.parquet(path))
    plan = _physical(totals)
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan and "partial_sum" in plan
