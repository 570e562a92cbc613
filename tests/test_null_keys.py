"""Registered events queries vs their SQL oracles on an events table that
has null user ids (the driver tables have no nulls)."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from martwright import registry
from conftest import SF_SMALL
from scripts.oracle_check import _digest, _duck_rows, _spark_rows

EVENT_QUERIES = ["take_until", "neighbour_diff", "threshold_summary", "threshold_rows",
                 "event_share", "record_count", "daily_revenue_events"]


@pytest.fixture(scope="module")
def null_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("nullkeys"))
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # every 7th user's events lose their user id: one null-key group
    ev = ev.withColumn("user_id", F.when(F.col("user_id") % 7 == 3, None)
                       .otherwise(F.col("user_id")))
    ev.coalesce(1).write.parquet(os.path.join(d, "events.parquet"))
    return d


@pytest.mark.parametrize("name", EVENT_QUERIES)
def test_events_query_with_null_keys(spark, null_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{null_dir}/events.parquet/*.parquet')")
    scols, srows = _spark_rows(registry.queries()[name](spark, null_dir))
    dcols, drows = _duck_rows(con, registry.oracle_sql()[name])
    assert scols == dcols
    assert len(srows) == len(drows)
    assert _digest(srows, None) == _digest(drows, None)
