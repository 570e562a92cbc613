"""Mixed lists, free records, and table functions planned without a join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martwright import registry
from martwright.functions import variants as V


def test_each_element_keeps_its_type(spark):
    df = spark.createDataFrame([(1, "a", 2.5, True, None), (None, "7", None, False, "x")],
                               "i int, s string, d double, b boolean, n string")
    xs = V.mixed_list("i", "s", "d", "b", "n")
    got = df.select(V.mixed_get(xs, 0, "int"), V.mixed_get(xs, 1, "int"), V.mixed_get(xs, 1, "string"), V.mixed_get(xs, 2, "double"),
                    V.mixed_get(xs, -2, "boolean"), V.mixed_get(xs, 4, "string"), V.mixed_get(xs, -6, "string"),
                    V.mixed_type(xs, 1), V.mixed_type(xs, 0), F.size(xs)).collect()
    assert [tuple(r) for r in got] == [
        (1, None, "a", 2.5, True, None, None, "STRING", "BIGINT", 5), (None, 7, "7", None, False, "x", None, "STRING", None, 5)]


def test_lists_in_lists(spark):
    row = spark.range(1).select(V.mixed_list(F.lit(1), F.array(F.lit("a"), F.lit("b"))).alias("xs"))
    assert row.select(V.mixed_get("xs", 1, "array<string>").alias("v")).first().v == ["a", "b"]


def test_records_with_different_fields(spark):
    a = spark.createDataFrame([(1, None)], "k int, `odd name` string")
    b = spark.createDataFrame([("x",)], "v string")
    both = V.append_records(a, b, b.limit(0))
    got = both.select(V.field("record", "k", "int"), V.field("record", "v", "string"), F.to_json("record")).collect()
    assert sorted(map(tuple, got), key=repr) == [(1, None, '{"k":1}'), (None, "x", '{"v":"x"}')]


@pytest.mark.parametrize("name", ["lateral_words", "lateral_pairs", "lateral_zip"])
def test_table_functions_are_generators(spark, name):
    plan = registry.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Join" not in plan and "Exchange" not in plan
