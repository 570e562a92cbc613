"""Join, null and text rules on tiny hand-made tables (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martwright.plans import datasets, marts

D = Decimal
T = dt.datetime


@pytest.fixture(scope="module")
def roles(spark):
    mk = spark.createDataFrame
    artist = mk([(1, "Ann"), (2, "Bo"), (3, "NoAlbum"), (4, "Ann")],
                "artist_id bigint, name string")
    album = mk([(10, 1, "A1"), (20, 2, "B1"), (21, 2, "B-empty"), (40, 4, "A2")],
               "album_id bigint, artist_id bigint, title string")
    track = mk([(100, 10, 1, "s100", D("1.00"), 5),
                (101, 10, None, "s101", D("2.00"), 6),    # null genre
                (200, 20, 9, "s200", D("3.00"), 7),       # unknown genre
                (300, 99, 1, "s300", D("4.00"), 8),       # album missing
                (400, 40, 2, "s400", D("5.00"), 9),
                (500, 10, 1, "no-lines", D("6.00"), 10)],
               "track_id bigint, album_id bigint, genre_id bigint, name string, "
               "unit_price decimal(10,2), bytes bigint")
    genre = mk([(1, "Rock"), (2, "Jazz")], "genre_id bigint, name string")
    line = mk([(1, 1000, 100, 2, D("1.50")),
               (2, 1000, 101, None, D("2.00")),    # null quantity -> 0.0
               (3, 1001, 200, 3, None),            # null price -> null
               (4, 1002, 300, 1, D("4.00")),       # track without album
               (5, 1003, 999, 1, D("1.00")),       # unknown track
               (6, 1004, 100, 1, D("1.00")),       # invoice missing
               (7, None, 100, 1, D("1.00")),       # null invoice id
               (8, 1005, 400, 1, D("10.00")),
               (9, 1006, 100, 1, D("1.00")),
               (10, 1007, 100, 1, D("1.00"))],
              "invoice_line_id bigint, invoice_id bigint, track_id bigint, "
              "quantity bigint, unit_price decimal(10,2)")
    invoice = mk([(1000, 1, D("3.00"), T(2024, 1, 1, 9, 0)),
                  (1001, 2, D("9.00"), T(2024, 1, 1, 17, 30)),
                  (1002, 3, D("4.00"), T(2024, 1, 2, 8, 0)),
                  (1005, 77, D("10.00"), T(2024, 1, 3, 8, 0)),   # customer missing
                  (1006, 4, D("1.00"), T(2024, 1, 4, 12, 0)),
                  (1007, 5, D("1.00"), T(2024, 1, 4, 12, 0))],  # same instant, same country
                 "invoice_id bigint, customer_id bigint, total decimal(10,2), "
                 "invoice_date timestamp_ntz")
    customer = mk([(1, "Ida", "Bj�rk", "Main �rive 1", "C", "S", "NO", "1", "a@x"),
                   (2, None, "Lee", "Elm 2", "C", "S", "NO", "2", "b@x"),
                   (3, "Kim", None, "Oak 3", "C", "S", None, "3", "c@x"),
                   (4, "Al", "Ray", "Pine 4", "C", "S", "SE", "4", "d@x"),
                   (5, "Jo", "Ray", "Pine 5", "C", "S", "SE", "5", "e@x")],
                  "customer_id bigint, first_name string, last_name string, address string, "
                  "city string, state string, country string, postal_code string, email string")
    return dict(artist=artist, album=album, track=track, genre=genre, line=line,
                invoice=invoice, customer=customer)


def _sales(r):
    return datasets.sales_lines(r["artist"], r["album"], r["track"], r["line"], r["invoice"])


def _tx(r):
    return datasets.transactions(r["track"], r["line"], r["invoice"], r["customer"])


def _catalog(r):
    return datasets.catalog(r["artist"], r["album"], r["track"], r["genre"])


def test_sales_lines_keeps_only_full_chains(roles):
    rows = {r.invoice_line_id: r for r in _sales(roles).collect()}
    # 4: track without album, 5: unknown track, 7: null invoice id
    assert set(rows) == {1, 2, 3, 6, 8, 9, 10}
    assert rows[1].total_price == pytest.approx(3.0)
    assert rows[2].total_price == 0.0          # null quantity
    assert rows[3].total_price is None         # null price
    assert rows[6].invoice_date is None        # invoice missing, line kept
    assert rows[8].artist_name == "Ann"


def test_transactions_rules(roles):
    rows = _tx(roles).collect()
    by_line = {}
    for r in rows:
        by_line.setdefault(r.invoice_id, []).append(r)
    # the line whose track has no album is kept here (1002); unknown track
    # (1003) and null invoice id are dropped; missing invoice (1004) kept
    assert set(by_line) == {1000, 1001, 1002, 1004, 1005, 1006, 1007}
    r1000 = by_line[1000][0]
    assert r1000.full_name == "Ida Bjork"                 # U+FFFD -> o
    assert r1000.address == "Main drive 1"                # U+FFFD -> d
    assert by_line[1001][0].full_name is None             # null first name
    assert by_line[1002][0].full_name is None             # null last name
    missing_cust = by_line[1005][0]
    assert missing_cust.customer_id is None and missing_cust.country is None
    assert missing_cust.total == 10.0
    assert by_line[1004][0].total is None and by_line[1004][0].invoice_date is None


def test_catalog_optional_genre(roles):
    rows = {r.track_id: r for r in _catalog(roles).collect()}
    assert set(rows) == {100, 101, 200, 400, 500}   # 300: album missing
    assert rows[101].genre_id is None and rows[101].genre_name is None
    assert rows[200].genre_id is None               # unknown genre -> genre table id null
    assert rows[100].unit_price == 1.0 and rows[100].bytes == 5


def test_artist_productivity_counts_zero_for_unknown_genre(roles):
    got = {(r.artist_name, r.genre_name): r.counted_songs
           for r in marts.artist_productivity(_catalog(roles)).collect()}
    assert got[("Ann", "Rock")] == 2
    assert got[("Ann", None)] == 0  # null genre group counts 0
    assert got[("Bo", None)] == 0
    assert got[("Ann", "Jazz")] == 1


def test_artist_revenue_merges_same_name(roles):
    got = {r.artist_name: r.total_revenue for r in marts.artist_revenue(_sales(roles)).collect()}
    # two artists named Ann: one row
    assert set(got) == {"Ann", "Bo"}
    assert got["Ann"] == pytest.approx(3.0 + 0.0 + 1.0 + 10.0 + 1.0 + 1.0)


def test_daily_revenue_groups_by_day(roles):
    got = {r.invoice_date: r.total_revenue for r in marts.daily_revenue(_sales(roles)).collect()}
    assert got[dt.date(2024, 1, 1)] == pytest.approx(3.0)  # null price line adds nothing
    assert None in got                                       # line without invoice


def test_visit_frequency_counts_instants(roles):
    got = {r.country: r.frequency_level
           for r in marts.visit_frequency(_tx(roles)).collect()}
    assert None not in got
    assert got["NO"] == 2   # two invoices on one day at different times
    assert got["SE"] == 1   # two invoices at one instant


def test_wrong_type_is_refused(spark):
    from pyspark.errors import AnalysisException

    from martwright.plans.schemas import SALES_LINES, conform

    columns = ", ".join(f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in SALES_LINES)
    bad = spark.sql(f"select {columns}").withColumn("artist_id", F.lit("x"))
    with pytest.raises(AnalysisException):
        conform(bad, SALES_LINES)


def _multiset(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_source_level_marts_equal_dataset_marts(roles):
    r = roles
    assert _multiset(marts.daily_revenue_from_sources(
        r["artist"], r["album"], r["track"], r["line"], r["invoice"])) == \
        _multiset(marts.daily_revenue(_sales(r)))
    assert _multiset(marts.artist_revenue_from_sources(
        r["artist"], r["album"], r["track"], r["line"], r["invoice"])) == \
        _multiset(marts.artist_revenue(_sales(r)))
    assert _multiset(marts.visit_frequency_from_sources(
        r["track"], r["line"], r["invoice"], r["customer"])) == \
        _multiset(marts.visit_frequency(_tx(r)))
    assert _multiset(marts.artist_productivity_from_sources(
        r["artist"], r["album"], r["track"], r["genre"])) == \
        _multiset(marts.artist_productivity(_catalog(r)))


def test_productivity_pre_count_exact_with_duplicate_dimension_ids(roles):
    r = dict(roles)
    r["album"] = r["album"].unionByName(r["album"].where("album_id = 10"))
    r["genre"] = r["genre"].unionByName(r["genre"].where("genre_id = 1"))
    assert _multiset(marts.artist_productivity_from_sources(
        r["artist"], r["album"], r["track"], r["genre"])) == \
        _multiset(marts.artist_productivity(_catalog(r)))


def test_daily_pre_aggregation_exact_with_duplicate_invoice_ids(roles):
    r = dict(roles)
    r["invoice"] = r["invoice"].unionByName(r["invoice"].where("invoice_id = 1000"))
    assert _multiset(marts.daily_revenue_from_sources(
        r["artist"], r["album"], r["track"], r["line"], r["invoice"])) == \
        _multiset(marts.daily_revenue(_sales(r)))
    assert _multiset(marts.visit_frequency_from_sources(
        r["track"], r["line"], r["invoice"], r["customer"])) == \
        _multiset(marts.visit_frequency(_tx(r)))


def test_artist_revenue_invoice_key_rule(roles):
    """With a repeated invoice id the shortcut (invoice id taken as the key)
    and the exact path differ; the exact path equals the dataset mart."""
    r = dict(roles)
    r["invoice"] = r["invoice"].unionByName(r["invoice"].where("invoice_id = 1000"))
    exact = marts.artist_revenue_from_sources(r["artist"], r["album"], r["track"], r["line"],
                                              r["invoice"])
    assert _multiset(exact) == _multiset(marts.artist_revenue(_sales(r)))
    shortcut = marts.artist_revenue_from_sources(r["artist"], r["album"], r["track"], r["line"],
                                                 r["invoice"], invoice_id_is_key=True)
    assert _multiset(shortcut) != _multiset(exact)


def test_one_scan_sales_marts_equal_separate_marts(roles):
    sl = _sales(roles)
    daily, artist = marts.split_sales_line_totals(marts.sales_line_totals(sl))
    assert _multiset(daily) == _multiset(marts.daily_revenue(sl))      # includes the null day
    assert _multiset(artist) == _multiset(marts.artist_revenue(sl))
