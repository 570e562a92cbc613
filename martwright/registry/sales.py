"""Registered sales queries: the three datasets and the four marts.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with an
independent SQL statement over the raw test tables.  The SQL keeps the shape
of the source queries (left-join chain, then a not-null filter), so it checks
the inner-join rewrite of the Spark side as well as the values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from martwright.plans import colocated, datasets, instants, marts
from martwright.plans.schemas import name_by_position
from martwright.registry._inputs import roles as _shared_roles
from martwright.registry._inputs import tables as _shared_tables
from martwright.sources import album_roles, catalog_roles, sales_roles, transaction_roles
from martwright.sources.staging import TEST_ADDRESS_REPAIR, TEST_LAST_NAME_REPAIR


def _tables(spark: SparkSession, sf_dir: str):
    return _shared_tables(spark, sf_dir)


def _sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _shared_roles(spark, sf_dir, sales_roles)
    return datasets.sales_lines(r["artist"], r["album"], r["track"],
                                r["invoice_line"], r["invoice"])


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _shared_roles(spark, sf_dir, catalog_roles)
    return datasets.catalog(r["artist"], r["album"], r["track"], r["genre"])


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _shared_roles(spark, sf_dir, transaction_roles)
    return datasets.transactions(r["track"], r["invoice_line"], r["invoice"], r["customer"],
                                 last_name_repair=TEST_LAST_NAME_REPAIR,
                                 address_repair=TEST_ADDRESS_REPAIR)


# The marts run from the source tables with the scale-shaped plans of
# ``marts.*_from_sources``; the refresh job aggregates the published datasets.

def _daily_revenue(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, sales_roles)
    return marts.daily_revenue_from_sources(r["artist"], r["album"], r["track"],
                                            r["invoice_line"], r["invoice"])


def _artist_revenue(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, sales_roles)
    return marts.artist_revenue_from_sources(r["artist"], r["album"], r["track"],
                                             r["invoice_line"], r["invoice"])


def _artist_productivity(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, catalog_roles)
    return marts.artist_productivity_from_sources(r["artist"], r["album"], r["track"],
                                                  r["genre"])


def _visit_frequency(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, transaction_roles)
    return marts.visit_frequency_from_sources(r["track"], r["invoice_line"], r["invoice"],
                                              r["customer"])


# What the refresh job runs: the marts of the datasets.

def _line_totals(spark, sf_dir):
    return marts.sales_line_totals(_sales_lines(spark, sf_dir))


def _dataset_daily_revenue(spark, sf_dir):
    return marts.split_sales_line_totals(_line_totals(spark, sf_dir))[0]


def _dataset_artist_revenue(spark, sf_dir):
    return marts.split_sales_line_totals(_line_totals(spark, sf_dir))[1]


def _dataset_artist_productivity(spark, sf_dir):
    return marts.artist_productivity(_catalog(spark, sf_dir))


def _dataset_visit_frequency(spark, sf_dir):
    return marts.visit_frequency(_transactions(spark, sf_dir))


def _rounded_line_totals(spark, sf_dir):
    t = _line_totals(spark, sf_dir)
    return t.select("invoice_date", "artist_name", F.col("_grouping_set").cast("int").alias("grouping_set"),
                    F.round("_raw_revenue", 2).alias("total_revenue"))


def _single_daily_revenue(spark, sf_dir):
    return marts.daily_revenue(_sales_lines(spark, sf_dir))


def _single_artist_revenue(spark, sf_dir):
    return marts.artist_revenue(_sales_lines(spark, sf_dir))


def _positional_names(spark, sf_dir):
    return name_by_position(_tables(spark, sf_dir)["nation"].select("n_nationkey", "n_name"),
                            ["album_id", "title"])


# The source's unused album join, on an album table whose ids repeat.
def _transactions_with_album(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, album_roles)
    return datasets.transactions(r["track"], r["invoice_line"], r["invoice"], r["customer"],
                                 last_name_repair=TEST_LAST_NAME_REPAIR,
                                 address_repair=TEST_ADDRESS_REPAIR, album=r["album"])


# Heavy invoices spread by their row counts.
def _sales_lines_salted(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, sales_roles)
    return datasets.sales_lines(r["artist"], r["album"], r["track"], r["invoice_line"], r["invoice"],
                                salted=True)


def _transactions_salted(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, transaction_roles)
    return datasets.transactions(r["track"], r["invoice_line"], r["invoice"], r["customer"],
                                 last_name_repair=TEST_LAST_NAME_REPAIR,
                                 address_repair=TEST_ADDRESS_REPAIR, salted=True)


# Lines and invoices published bucketed by the invoice key, joined where they lie.
def _sales_lines_colocated(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, sales_roles)
    tables = colocated.publish_line_tables(r["invoice_line"], r["invoice"].select("invoice_id", "invoice_date"))
    return colocated.sales_lines(r["artist"], r["album"], r["track"], tables)


def _transactions_colocated(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, transaction_roles)
    tables = colocated.publish_customer_invoices(r["invoice_line"], r["invoice"], r["customer"],
                                                 TEST_LAST_NAME_REPAIR, TEST_ADDRESS_REPAIR)
    return colocated.transactions(r["track"], tables)


# Distinct instants kept as bitmaps: a first load, then the later visits.
SECOND_LOAD = "1995-01-01"


def _visit_frequency_bitmaps(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, transaction_roles)
    visits = marts.visits_from_sources(r["track"], r["invoice_line"], r["invoice"], r["customer"]).select(
        "country", F.col("invoice_date").alias("instant"))
    early = F.coalesce(F.col("instant") < F.lit(SECOND_LOAD).cast("timestamp_ntz"), F.lit(False))
    dictionary, bitmaps = instants.add_visits(visits.where(early))
    _, bitmaps = instants.add_visits(visits.where(~early), dictionary, bitmaps)
    return instants.frequency(bitmaps)


def _daily_revenue_events(spark, sf_dir):
    events = _tables(spark, sf_dir)["events"]
    return marts.daily_totals(events, "ts", "value")


SALES_LINES_SQL = """
SELECT CAST(r.r_regionkey AS BIGINT)  AS artist_id,
       CAST(s.s_suppkey AS BIGINT)    AS track_id,
       CAST(l.l_linenumber AS BIGINT) AS invoice_line_id,
       CAST(l.l_orderkey AS BIGINT)   AS invoice_id,
       r.r_name AS artist_name,
       n.n_name AS album_title,
       s.s_name AS song_title,
       CASE WHEN l.l_quantity IS NULL THEN CAST(0 AS DOUBLE)
            ELSE CAST(l.l_quantity * l.l_extendedprice AS DOUBLE) END AS total_price,
       o.o_orderdate AS invoice_date
FROM region r
LEFT JOIN nation n   ON r.r_regionkey = n.n_regionkey
LEFT JOIN supplier s ON n.n_nationkey = s.s_nationkey
LEFT JOIN lineitem l ON s.s_suppkey = l.l_suppkey
LEFT JOIN orders o   ON l.l_orderkey = o.o_orderkey
WHERE l.l_orderkey IS NOT NULL
"""

CATALOG_SQL = """
SELECT CAST(n.n_nationkey AS BIGINT) AS artist_id,
       CAST(c.c_custkey AS BIGINT)   AS album_id,
       CAST(o.o_orderkey AS BIGINT)  AS track_id,
       CAST(g.r_regionkey AS BIGINT) AS genre_id,
       n.n_name          AS artist_name,
       c.c_name          AS album_title,
       o.o_orderstatus   AS song_title,
       g.r_name          AS genre_name,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS unit_price,
       CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS bytes
FROM nation n
LEFT JOIN customer c    ON n.n_nationkey = c.c_nationkey
LEFT JOIN orders o      ON c.c_custkey = o.o_custkey
LEFT JOIN region g      ON CAST(split_part(o.o_orderpriority, '-', 1) AS BIGINT) = g.r_regionkey
WHERE o.o_orderkey IS NOT NULL
"""

TRANSACTIONS_SQL = f"""
SELECT CAST(c.c_custkey AS BIGINT)  AS customer_id,
       CAST(p.p_partkey AS BIGINT)  AS track_id,
       CAST(l.l_orderkey AS BIGINT) AS invoice_id,
       c.c_mktsegment || ' ' || replace(c.c_name, '{TEST_LAST_NAME_REPAIR[0]}',
                                        '{TEST_LAST_NAME_REPAIR[1]}') AS full_name,
       replace(c.c_name, '{TEST_ADDRESS_REPAIR[0]}', '{TEST_ADDRESS_REPAIR[1]}') AS address,
       c.c_mktsegment AS city,
       r.r_name       AS state,
       n.n_name       AS country,
       CAST(c.c_nationkey AS VARCHAR) AS postal_code,
       lower(c.c_name) || '@example.com' AS email,
       CAST(o.o_totalprice AS DOUBLE) AS total,
       o.o_orderdate AS invoice_date
FROM part p
LEFT JOIN lineitem l ON p.p_partkey = l.l_partkey
LEFT JOIN orders o   ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n   ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r   ON n.n_regionkey = r.r_regionkey
WHERE l.l_orderkey IS NOT NULL
"""

# Read-side orders: the place of each row as a column.
def _daily_revenue_report(spark, sf_dir):
    return marts.positioned("daily_revenue", _daily_revenue(spark, sf_dir))


def _artist_productivity_report(spark, sf_dir):
    return marts.positioned("artist_productivity", _artist_productivity(spark, sf_dir))


def _artist_revenue_report(spark, sf_dir):
    r = _shared_roles(spark, sf_dir, sales_roles)
    return marts.artist_revenue_from_sources(r["artist"], r["album"], r["track"],
                                             r["invoice_line"], r["invoice"], positions=True)


def _visit_frequency_report(spark, sf_dir):
    return marts.positioned("visit_frequency", _visit_frequency(spark, sf_dir))


def _sales_lines_report(spark, sf_dir):
    return marts.positioned("sales_lines", _sales_lines(spark, sf_dir))


def _catalog_report(spark, sf_dir):
    return marts.positioned("catalog", _catalog(spark, sf_dir))


def _transactions_report(spark, sf_dir):
    return marts.positioned("transactions", _transactions(spark, sf_dir))


QUERIES = {
    "sales_lines": _sales_lines,
    "catalog": _catalog,
    "transactions": _transactions,
    "daily_revenue": _daily_revenue,
    "artist_productivity": _artist_productivity,
    "artist_revenue": _artist_revenue,
    "visit_frequency": _visit_frequency,
    "daily_revenue_events": _daily_revenue_events,
    "sales_line_totals": _rounded_line_totals,
    "dataset_daily_revenue": _dataset_daily_revenue,
    "dataset_artist_revenue": _dataset_artist_revenue,
    "dataset_daily_revenue_alone": _single_daily_revenue,
    "dataset_artist_revenue_alone": _single_artist_revenue,
    "dataset_artist_productivity": _dataset_artist_productivity,
    "dataset_visit_frequency": _dataset_visit_frequency,
    "transactions_with_album": _transactions_with_album,
    "sales_lines_salted": _sales_lines_salted,
    "transactions_salted": _transactions_salted,
    "sales_lines_colocated": _sales_lines_colocated,
    "transactions_colocated": _transactions_colocated,
    "visit_frequency_bitmaps": _visit_frequency_bitmaps,
    "positional_names": _positional_names,
    "daily_revenue_report": _daily_revenue_report,
    "artist_productivity_report": _artist_productivity_report,
    "artist_revenue_report": _artist_revenue_report,
    "visit_frequency_report": _visit_frequency_report,
    "sales_lines_report": _sales_lines_report,
    "catalog_report": _catalog_report,
    "transactions_report": _transactions_report,
}

ORACLE = {
    "sales_lines": SALES_LINES_SQL,
    "catalog": CATALOG_SQL,
    "transactions": TRANSACTIONS_SQL,
    "daily_revenue": f"""
WITH sl AS ({SALES_LINES_SQL})
SELECT CAST(invoice_date AS DATE) AS invoice_date,
       ROUND(SUM(total_price), 2) AS total_revenue
FROM sl GROUP BY 1
""",
    "artist_productivity": f"""
WITH cat AS ({CATALOG_SQL})
SELECT artist_name, genre_name, COUNT(genre_name) AS counted_songs
FROM cat GROUP BY artist_name, genre_name
""",
    "artist_revenue": f"""
WITH sl AS ({SALES_LINES_SQL})
SELECT artist_name, ROUND(SUM(total_price), 2) AS total_revenue
FROM sl GROUP BY artist_name
""",
    "visit_frequency": f"""
WITH tx AS ({TRANSACTIONS_SQL})
SELECT country, COUNT(DISTINCT invoice_date) AS frequency_level
FROM tx WHERE country IS NOT NULL GROUP BY country
""",
    "daily_revenue_events": """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, ROUND(SUM(value), 2) AS total_value
FROM events GROUP BY 1
""",
}

for _mart in ("daily_revenue", "artist_revenue", "artist_productivity", "visit_frequency"):
    ORACLE[f"dataset_{_mart}"] = ORACLE[_mart]
ORACLE["dataset_daily_revenue_alone"] = ORACLE["daily_revenue"]
ORACLE["dataset_artist_revenue_alone"] = ORACLE["artist_revenue"]
ORACLE["sales_line_totals"] = f"""
WITH sl AS ({SALES_LINES_SQL})
SELECT CAST(invoice_date AS DATE) AS invoice_date, NULL AS artist_name, 1 AS grouping_set,
       ROUND(SUM(total_price), 2) AS total_revenue
FROM sl GROUP BY 1
UNION ALL
SELECT NULL, artist_name, 2, ROUND(SUM(total_price), 2) FROM sl GROUP BY artist_name
"""
ORACLE["transactions_with_album"] = TRANSACTIONS_SQL.replace(
    "LEFT JOIN lineitem l ON", "LEFT JOIN nation a ON a.n_regionkey = p.p_size\nLEFT JOIN lineitem l ON")
for _name in ("sales_lines", "transactions"):
    ORACLE[f"{_name}_salted"] = ORACLE[f"{_name}_colocated"] = ORACLE[_name]
ORACLE["visit_frequency_bitmaps"] = ORACLE["visit_frequency"]
ORACLE["positional_names"] = "SELECT n_nationkey AS album_id, n_name AS title FROM nation\n"



def _numbered(name: str, order: str, sql: str | None = None) -> str:
    """The rows of a query with their place by ``order``."""
    return f"""
WITH report AS ({sql or ORACLE[name]})
SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM report
"""


# Report orders: the marts' ORDER BY clauses (nulls first, as in the warehouse),
# the extracts' (nulls last, as in the source database), then the other columns.
ORACLE["daily_revenue_report"] = _numbered("daily_revenue", "invoice_date NULLS FIRST")
ORACLE["artist_productivity_report"] = _numbered(
    "artist_productivity", "genre_name ASC NULLS FIRST, counted_songs DESC NULLS FIRST, artist_name NULLS LAST")
ORACLE["artist_revenue_report"] = f"""
WITH sl AS ({SALES_LINES_SQL}),
raw AS (SELECT artist_name, SUM(total_price) AS revenue FROM sl GROUP BY artist_name)
SELECT artist_name, ROUND(revenue, 2) AS total_revenue,
       row_number() OVER (ORDER BY revenue DESC NULLS FIRST, artist_name NULLS LAST) AS position
FROM raw
"""
ORACLE["visit_frequency_report"] = _numbered(
    "visit_frequency", "frequency_level DESC NULLS FIRST, country NULLS FIRST")
ORACLE["sales_lines_report"] = _numbered("sales_lines", ", ".join(f"{c} ASC NULLS LAST" for c in (
    "artist_id", "invoice_id", "invoice_line_id", "track_id", "artist_name", "album_title", "song_title",
    "total_price", "invoice_date")))
ORACLE["catalog_report"] = _numbered("catalog", ", ".join(f"{c} ASC NULLS LAST" for c in (
    "artist_id", "track_id", "album_id", "genre_id", "artist_name", "album_title", "song_title", "genre_name",
    "unit_price", "bytes")))
ORACLE["transactions_report"] = _numbered("transactions", ", ".join(f"{c} ASC NULLS LAST" for c in (
    "customer_id", "invoice_id", "track_id", "full_name", "address", "city", "state", "country", "postal_code",
    "email", "total", "invoice_date")))
