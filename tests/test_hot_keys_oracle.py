"""Every registered query vs its SQL oracle when one key holds a third of
the rows: one invoice, one supplier and one part carry a third of the lines,
one customer a third of the orders, one user a third of the events.  Broadcasts are off, so every join takes
the sort-merge path a 100 TB run takes, with AQE's skew handling on; results
must stay exact and whole.  (Whether AQE splits a partition depends on its
compressed size; ``test_skew.py`` builds data where it must and asserts the
split.)"""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from martwright import registry
from conftest import SF_SMALL
from scripts.oracle_check import _digest, _duck_rows, _spark_rows

TABLES = ["region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events"]
SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    # no broadcasts: every join is a sort-merge join, the path a 100 TB run
    # takes, so the skewed partitions have to be split
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("hot"))
    t = {n: spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in TABLES}
    c = F.col
    third = (F.xxhash64("l_orderkey", "l_linenumber", "l_partkey") % 3) == 0
    li = (t["lineitem"]
          .withColumn("l_orderkey", F.when(third, F.lit(7).cast("bigint")).otherwise(c("l_orderkey")))
          .withColumn("l_suppkey", F.when(third, F.lit(3).cast("bigint")).otherwise(c("l_suppkey")))
          .withColumn("l_partkey", F.when(third, F.lit(11).cast("bigint")).otherwise(c("l_partkey"))))
    ev = t["events"].withColumn(
        "user_id", F.when(c("event_id") % 3 == 0, F.lit(5).cast("bigint")).otherwise(c("user_id")))
    # one customer (an album in the catalog, a buyer in the transactions)
    # places a third of the orders
    od = t["orders"].withColumn(
        "o_custkey", F.when(c("o_orderkey") % 3 == 0, F.lit(5).cast("bigint")).otherwise(c("o_custkey")))
    hot = dict(t, lineitem=li, events=ev, orders=od)
    for name, df in hot.items():
        df.repartition(4).write.parquet(os.path.join(d, f"{name}.parquet"))
    return d


@pytest.fixture(scope="module")
def con(hot_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{hot_dir}/{t}.parquet/*.parquet')")
    yield c
    c.close()


@pytest.fixture(scope="module")
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _uses_only(name):
    sql = registry.oracle_sql()[name].lower()
    return all(f" {t}" not in sql for t in
               ("documents", "pages", "conversations", "embeddings", "labels", "benchmark"))


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if _uses_only(n)))
def test_query_with_hot_keys(skew_session, con, hot_dir, name):
    scols, srows = _spark_rows(registry.queries()[name](skew_session, hot_dir))
    dcols, drows = _duck_rows(con, registry.oracle_sql()[name])
    assert scols == dcols
    assert len(srows) == len(drows)
    assert _digest(srows, None) == _digest(drows, None)


def test_hot_joins_take_the_sort_merge_path(skew_session, hot_dir):
    df = registry.queries()["transactions"](skew_session, hot_dir)
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    plan = qe.executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
