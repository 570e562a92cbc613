"""Order-independent sums: the same bits under any partitioning."""

from __future__ import annotations

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from martwright.functions.exact_sum import exact_sum, merged_parts, sum_of_parts, sum_parts
from martwright.plans import marts


def _bits(x):
    return None if x is None else struct.pack(">d", x)


@pytest.fixture(scope="module")
def values():
    rng = random.Random(5)
    out = [(k % 7, rng.uniform(-1, 1) * 10 ** rng.randrange(-4, 15)) for k in range(20_000)]
    out += [(0, 0.1), (0, -0.0), (1, None), (8, None), (9, 0.1), (9, 0.2), (10, 1e15), (10, 0.125), (10, -1e15),
            (11, -0.375), (12, 2.0 ** 61), (12, -2.0 ** 61), (12, 2.0 ** -20)]
    out += [(13, 0.1)] * 1000 + [(14, 49.995)] * 333
    rng.shuffle(out)
    return out


def test_same_bits_under_any_partitioning(spark, values):
    df = spark.createDataFrame(values, "k int, x double")
    want = {}
    for k, x in values:
        want.setdefault(k, []).append(x)
    seen = []
    for n in (1, 7, 211):
        got = {r.k: r.s for r in df.repartition(n).groupBy("k").agg(exact_sum("x").alias("s")).collect()}
        seen.append({k: _bits(v) for k, v in got.items()})
    assert seen[0] == seen[1] == seen[2]
    for k, xs in want.items():
        xs = [x for x in xs if x is not None]
        exact = math.fsum(xs) if xs else None
        assert got[k] == exact or abs(got[k] - exact) <= math.ulp(exact), (k, got[k], exact)


def test_several_steps_give_the_same_bits(spark, values):
    df = spark.createDataFrame(values, "k int, x double").withColumn("step", F.rand(3) * 9)
    once = {r.k: _bits(r.s) for r in df.groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    steps = (df.groupBy("k", F.floor("step").alias("step")).agg(*sum_parts("x", "p"))
             .groupBy("k").agg(*merged_parts("p")).select("k", sum_of_parts("p").alias("s")))
    assert {r.k: _bits(r.s) for r in steps.collect()} == once


def test_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, inf), (1, 1.0), (2, inf), (2, -inf), (3, nan), (3, 2.0), (4, 1e300), (4, 1.0), (5, 1e19), (5, 5e18)]
    got = {r.k: r.s for r in spark.createDataFrame(rows, "k int, x double").repartition(5)
           .groupBy("k").agg(exact_sum("x").alias("s")).collect()}
    assert got[1] == inf and math.isnan(got[2]) and math.isnan(got[3])
    assert got[4] == 1e300 and got[5] == 1.5e19


def test_marts_keep_a_half_cent_tie(spark):
    """Sums on a half cent round alike however the lines are dealt out."""
    rows = [("a", x) for x in [0.1, 0.2, 0.3, 0.005] * 500 + [1e9, -1e9] * 100]
    lines = spark.createDataFrame(rows, "artist_name string, total_price double").withColumn(
        "invoice_date", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    found = set()
    for n in (1, 7, 211):
        dealt = lines.repartition(n)
        found.add((marts.artist_revenue(dealt).first().total_revenue, marts.daily_revenue(dealt).first().total_revenue,
                   marts.sales_line_totals(dealt).orderBy("_grouping_set").first()._raw_revenue))
    assert len(found) == 1
