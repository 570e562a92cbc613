"""Global positions: dense, in order, over many partitions, ties and nulls."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from martwright.operators import with_positions
from martwright.sinks import clean


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_positions_are_the_places_in_order(spark, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        # a third of the rows share one key, some keys are null
        df = spark.range(5_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 != 0, F.col("id") % 101).alias("k"))
        rows = with_positions(df, F.col("k").desc_nulls_last(), F.col("id")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(rows, key=lambda r: (r.k is None, -(r.k or 0), r.id))
    assert [r.position for r in want] == list(range(1, 5_001))


def test_ties_and_repeated_rows_get_places_of_their_own(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(0, "b")], "k int, v string").repartition(4)
    rows = with_positions(df, F.col("k"), name="place").collect()
    assert sorted((r.place, r.k) for r in rows) == [(1, 0), *((p, 1) for p in range(2, 7))]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], "k int, _place int")
    out = with_positions(df, F.col("k"))
    assert out.columns == ["k", "_place", "position"] and out.count() == 0
    with pytest.raises(ValueError):
        with_positions(out, F.col("k"))
    with pytest.raises(ValueError):
        with_positions(df)


def test_no_window_and_no_single_partition(spark):
    out = with_positions(spark.range(100).toDF("k"), F.col("k"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_intermediate_tables_can_be_removed(spark):
    with_positions(spark.range(10).toDF("k"), F.col("k"))
    assert clean(spark) is True
    assert clean(spark) is False
