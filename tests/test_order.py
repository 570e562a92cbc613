"""Report orders (O1-O5): null position and tie-breaks on collected rows."""

from __future__ import annotations

import datetime as dt

from martwright.plans import marts


def test_daily_revenue_nulls_first(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), 1.0), (None, 2.0), (dt.date(2024, 1, 1), 3.0)],
        "invoice_date date, total_revenue double")
    got = [r.invoice_date for r in marts.ordered("daily_revenue", df).collect()]
    assert got == [None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_extract_nulls_last(spark):
    df = spark.createDataFrame([(None, 1, 1), (2, 2, 2), (1, None, 3), (1, 3, 4)],
                               "customer_id bigint, invoice_id bigint, track_id int")
    got = [r.customer_id for r in marts.ordered("transactions", df).collect()]
    assert got == [1, 1, 2, None]
    assert [r.track_id for r in marts.ordered("transactions", df).collect()] == [4, 3, 2, 1]


def test_catalog_two_keys(spark):
    df = spark.createDataFrame([(2, 1), (1, 9), (1, 3)], "artist_id bigint, track_id bigint")
    got = [(r.artist_id, r.track_id) for r in marts.ordered("catalog", df).collect()]
    assert got == [(1, 3), (1, 9), (2, 1)]


def test_productivity_genre_asc_count_desc(spark):
    df = spark.createDataFrame(
        [("a", "Rock", 1), ("b", "Rock", 5), ("c", None, 0), ("d", "Jazz", 2)],
        "artist_name string, genre_name string, counted_songs bigint")
    got = [r.artist_name for r in marts.ordered("artist_productivity", df).collect()]
    assert got == ["c", "d", "b", "a"]


def test_visit_frequency_desc_then_country(spark):
    df = spark.createDataFrame([("B", 2), ("A", 2), ("C", 5)],
                               "country string, frequency_level bigint")
    got = [r.country for r in marts.ordered("visit_frequency", df).collect()]
    assert got == ["C", "A", "B"]


def test_artist_revenue_orders_by_unrounded_sum(spark):
    # rounded both to 1.0; the raw sums differ, and the raw order decides
    lines = spark.createDataFrame(
        [("x", 1.004), ("y", 1.0), ("y", 0.0049)],
        "artist_name string, total_price double")
    got = [(r.artist_name, r.total_revenue)
           for r in marts.ordered_artist_revenue(lines).collect()]
    assert [g[0] for g in got] == ["y", "x"]
    assert got[0][1] == 1.0 and got[1][1] == 1.0
