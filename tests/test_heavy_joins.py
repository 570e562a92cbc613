"""Multiplicity, salted and co-located joins; bitmaps of instants."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martwright.operators import heavy_keys, repeated, salted_join, with_matches
from martwright.plans import colocated, instants
from martwright.sinks import clean
from martwright.sources import read_parquet_tables, sales_roles

SF_LARGE = "/root/testdata/sf0.1"


def _rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- J4 ----------------------------------------------------------------------

def test_matches_repeat_rows_as_a_left_join_does(spark):
    rng = random.Random(1)
    left = spark.createDataFrame([(k, rng.choice([None, 1, 2, 3, 4])) for k in range(60)] + [(0, 1)], "id int, k int")
    other = spark.createDataFrame([(1, "a")] + [(2, "b")] * 5 + [(3, "c")] * 2600 + [(None, "n"), (9, "z")], "ok int, v string")
    want = _rows(left.join(other, left.k == other.ok, "left").select("id", "k"))
    assert _rows(repeated(with_matches(left, "k", other, "ok"))) == want
    assert _rows(repeated(with_matches(left, "k", other.limit(0), "ok"))) == _rows(left)
    assert repeated(with_matches(left.limit(0), "k", other, "ok")).count() == 0


def test_the_other_table_is_reduced_before_the_join(spark):
    left, other = spark.range(10).toDF("k"), spark.range(10).select((F.col("id") % 3).alias("ok"), F.lit("x").alias("v"))
    plan = repeated(with_matches(left, "k", other, "ok"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


# --- heavy keys --------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """The sf0.1 lines with a third of them on one invoice, and the invoices."""
    r = sales_roles(read_parquet_tables(spark, SF_LARGE))
    third = F.xxhash64("invoice_id", "invoice_line_id", "track_id") % 3 == 0
    lines = r["invoice_line"].withColumn("invoice_id", F.when(third, F.lit(7).cast("bigint")).otherwise(F.col("invoice_id")))
    return lines, r["invoice"].select("invoice_id", "invoice_date")


def test_the_sketch_finds_the_heavy_key(spark, skewed):
    lines, _ = skewed
    heavy, total = heavy_keys(lines, "invoice_id")
    assert list(heavy) == [7] and total == lines.count()
    assert abs(heavy[7] - lines.where("invoice_id = 7").count()) <= total / 1000
    assert heavy_keys(lines.where("invoice_id <> 7"), "invoice_id")[0] == {}
    assert heavy_keys(lines.limit(0), "invoice_id") == ({}, 0)


def _tasks_of_hot(df):
    parts = df.where("invoice_id = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()
    return len(parts), max(r["count"] for r in parts)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_invoice_is_spread_with_default_bounds(no_broadcast, skewed, how):
    lines, invoices = skewed
    hot = lines.where("invoice_id = 7").count()
    plain, salted = lines.join(invoices, "invoice_id", how), salted_join(lines, invoices, "invoice_id", how)
    old = no_broadcast.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _tasks_of_hot(plain)[0] == 1  # below AQE's byte bound: all in one task
        tasks, most = _tasks_of_hot(salted)
    finally:
        no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert tasks >= 6 and most < hot / 2
    key = F.xxhash64(*sorted(plain.columns))
    assert (plain.agg(F.count("*"), F.sum(key.cast("decimal(38,0)"))).first()
            == salted.select(plain.columns).agg(F.count("*"), F.sum(key.cast("decimal(38,0)"))).first())


def test_salted_join_of_small_tables(spark):
    left = spark.createDataFrame([(1, k) for k in range(50)] + [(None, 1), (2, 2), (3, 3)], "k int, a int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n"), (9, "q")], "k int, b string")
    for how in ("left", "inner"):
        assert _rows(salted_join(left, right, "k", how)) == _rows(left.join(right, "k", how))
        assert _rows(salted_join(left.limit(0), right, "k", how)) == Counter()
        assert _rows(salted_join(left, right.limit(0), "k", how)) == _rows(left.join(right.limit(0), "k", how))
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "right")
    with pytest.raises(ValueError):
        salted_join(left.withColumn("_SALT", F.lit(1)), right, "k")


# --- co-located --------------------------------------------------------------

def test_published_lines_join_without_an_exchange(no_broadcast):
    r = sales_roles(read_parquet_tables(no_broadcast, "/root/testdata/sf0.01"))
    invoices = r["invoice"].select("invoice_id", "invoice_date")
    tables = colocated.publish_line_tables(r["invoice_line"], invoices, buckets=8)
    joined = tables.joined()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert tables.heavy_lines is None
    want = r["invoice_line"].join(invoices, "invoice_id", "left")
    assert _rows(joined.select(want.columns)) == _rows(want)


def test_heavy_invoices_stay_out_of_the_buckets(no_broadcast, skewed):
    lines, invoices = skewed
    tables = colocated.publish_line_tables(lines, invoices, buckets=8)
    assert tables.heavy == (7,) and tables.lines.where("invoice_id = 7").count() == 0
    want, got = lines.join(invoices, "invoice_id", "left"), tables.joined()
    key = F.xxhash64(*sorted(want.columns)).cast("decimal(38,0)")
    assert want.agg(F.count("*"), F.sum(key)).first() == got.agg(F.count("*"), F.sum(key)).first()


def test_null_keys_repeated_invoices_and_empty_tables(spark):
    lines = spark.createDataFrame([(None, 1)] * 3 + [(1, 2), (2, 3), (5, 4)], "invoice_id long, v int")
    invoices = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "invoice_id long, d string")
    for a, b in ((lines, invoices), (lines.limit(0), invoices), (lines, invoices.limit(0))):
        tables = colocated.publish_line_tables(a, b, buckets=4, share=0.9)
        assert _rows(tables.joined()) == _rows(a.join(b, "invoice_id", "left"))
    assert clean(spark) and not [t for t in spark.catalog.listTables() if t.name.startswith("martwright_")]


# --- bitmaps of instants -----------------------------------------------------

def test_merged_days_equal_a_distinct_count(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", "c", None]), rng.randrange(40_000), rng.randrange(4)) for _ in range(60_000)]
    rows += [("only nulls", None, 1), ("a", None, 2)]
    visits = spark.createDataFrame(rows, "country string, s long, day int").select(
        "country", F.timestamp_seconds("s").cast("timestamp_ntz").alias("instant"), "day")
    dictionary = bitmaps = None
    for day in range(4):
        before = _rows(dictionary) if dictionary is not None else Counter()
        dictionary, bitmaps = instants.add_visits(visits.where(F.col("day") == day), dictionary, bitmaps)
        assert before - _rows(dictionary) == Counter()  # known codes stay
        want = (visits.where((F.col("day") <= day) & F.col("country").isNotNull()).groupBy("country")
                .agg(F.countDistinct("instant").alias("n")))
        assert _rows(instants.frequency(bitmaps)) == _rows(want)
    codes = sorted(r.code for r in dictionary.collect())
    assert codes == list(range(1, len(codes) + 1))


def test_the_merge_reads_no_former_visit(spark):
    visits = spark.createDataFrame([("a", 1)], "country string, s long").select(
        "country", F.timestamp_seconds("s").cast("timestamp_ntz").alias("instant"))
    dictionary, bitmaps = instants.add_visits(visits)
    merged = instants.merge_bitmaps(bitmaps, instants.visit_bitmaps(visits.limit(0), dictionary))
    assert "bitmaps-" in str(merged.inputFiles()) and _rows(instants.frequency(merged)) == Counter([("a", 1)])
