"""Hot keys: one artist and one invoice hold over a third of all lines.

AQE's skew thresholds are lowered for this module so the skew-join split
really happens on small data; the results must stay exact and whole.
"""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from martwright.plans import datasets, marts
from martwright.session import checkpoint_dir

HOT_LINES = 40000


@pytest.fixture(scope="module")
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        # AQE splits a skewed partition along map outputs; keep several
        # mappers on this tiny input instead of coalescing them into one
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark, skew_conf):
    rng = random.Random(3)
    mk = spark.createDataFrame
    artist = mk([(a, f"artist{a}") for a in range(10)], "artist_id bigint, name string")
    album = mk([(a * 10 + k, a, f"album{a}-{k}") for a in range(10) for k in range(3)],
               "album_id bigint, artist_id bigint, title string")
    album_ids = [a * 10 + k for a in range(10) for k in range(3)]
    track = mk([(t, rng.choice(album_ids), f"t{t}") for t in range(300)],
               "track_id bigint, album_id bigint, name string")
    # tracks 0..9 belong to artist 0's albums -> artist 0 is hot
    track = track.union(mk([(1000 + t, 0, f"hot{t}") for t in range(10)],
                           "track_id bigint, album_id bigint, name string"))
    lines, lid = [], 0
    # the hot part: one invoice, one artist.  It must stay large after shuffle
    # compression (AQE compares compressed block sizes), hence the count.
    for _ in range(HOT_LINES):
        lines.append((lid, 77, 1000 + rng.randrange(10), 1, Decimal("1.25")))
        lid += 1
    for _ in range(4000):
        lines.append((lid, rng.randrange(500), rng.randrange(300), rng.randrange(1, 4),
                      Decimal(rng.randrange(100, 999)) / 100))
        lid += 1
    line = mk(lines, "invoice_line_id bigint, invoice_id bigint, track_id bigint, "
                     "quantity bigint, unit_price decimal(10,2)")
    base = dt.datetime(2024, 3, 1)
    invoice = mk([(i, i % 40, Decimal("10.00"), base + dt.timedelta(hours=i)) for i in range(500)],
                 "invoice_id bigint, customer_id bigint, total decimal(10,2), "
                 "invoice_date timestamp_ntz")
    customer = mk([(c, "F", "L", "A", "C", "S", f"country{c % 3}", "P", "e")
                   for c in range(40)],
                  "customer_id bigint, first_name string, last_name string, address string, "
                  "city string, state string, country string, postal_code string, "
                  "email string")
    return dict(artist=artist, album=album, track=track, line=line, invoice=invoice,
                customer=customer, lines=lines)


def test_hot_artist_revenue_is_exact(hot):
    sl = datasets.sales_lines(hot["artist"], hot["album"], hot["track"], hot["line"],
                              hot["invoice"])
    got = {r.artist_name: r.total_revenue for r in marts.artist_revenue(sl).collect()}
    assert got["artist0"] >= HOT_LINES * 1.25
    assert sl.count() == len(hot["lines"])  # every line's track exists


def test_hot_invoice_transactions_are_whole(hot):
    tx = datasets.transactions(hot["track"], hot["line"], hot["invoice"], hot["customer"])
    assert tx.count() == len(hot["lines"])
    assert tx.where("invoice_id = 77").count() >= HOT_LINES
    freq = {r.country: r.frequency_level for r in marts.visit_frequency(tx).collect()}
    inv_ids = {ln[1] for ln in hot["lines"]}
    expect = {}
    for i in inv_ids:
        expect.setdefault(f"country{(i % 40) % 3}", set()).add(i)
    assert freq == {k: len(v) for k, v in expect.items()}


def test_checkpoint_dir_uses_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    if configured:
        assert got == configured
    assert spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark) == got  # stable, no new folder per call


def test_hot_invoice_join_is_split_by_aqe(hot):
    tx = datasets.transactions(hot["track"], hot["line"], hot["invoice"], hot["customer"])
    qe = tx._jdf.queryExecution()
    qe.toRdd().count()  # run this plan so its adaptive plan is final
    plan = qe.executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin" in plan
    assert "isSkewJoin=true" in plan or "skew=true" in plan


def _rows_by_task(df):
    from pyspark.sql import functions as F

    return df.withColumn("task", F.spark_partition_id())


def test_report_sort_splits_a_hot_artist(spark, hot):
    sl = datasets.sales_lines(hot["artist"], hot["album"], hot["track"], hot["line"], hot["invoice"])
    tasks = _rows_by_task(marts.ordered("sales_lines", sl)).where("artist_name = 'artist0'").select("task").distinct()
    assert tasks.count() > 1
    tx = datasets.transactions(hot["track"], hot["line"], hot["invoice"], hot["customer"])
    # one invoice of one customer: the third key splits it
    tasks = _rows_by_task(marts.ordered("transactions", tx)).where("invoice_id = 77").select("task").distinct()
    assert tasks.count() > 1


def test_neighbour_diff_splits_a_hot_day_and_shuffles_rows_once(spark, skew_conf):
    from pyspark.sql import functions as F

    from martwright.operators import neighbour_diff

    rows = spark.range(20000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 != 0, 1).otherwise(F.col("id") % 50).alias("user_id"),
        (F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=(F.col("id") * 4 % 86400).cast("decimal(18,6)"))).alias("ts"),
        (F.col("id") % 17).cast("double").alias("value"))
    out = neighbour_diff(rows, "user_id", "ts", "event_id", "value")
    assert _rows_by_task(out).where("user_id = 1").select("task").distinct().count() > 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the rows once, the chunks' last values twice and for the join
    assert plan.count("Exchange hashpartitioning") == 4
    assert out.count() == 20000
