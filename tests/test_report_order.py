"""The registered report queries give their rows the positions of DuckDB's
ORDER BY: the rows by position have the sort keys in the same order."""

from __future__ import annotations

import duckdb
import pytest

from martwright import registry
from conftest import SF_CHECK
from martwright.sources.tables import TEST_TABLES

SORT_KEYS = {
    "daily_revenue_report": ["invoice_date"],
    "artist_productivity_report": ["genre_name", "counted_songs"],
    "artist_revenue_report": ["artist_name"],
    "visit_frequency_report": ["frequency_level", "country"],
    "sales_lines_report": ["artist_id"],
    "catalog_report": ["artist_id", "track_id"],
    "transactions_report": ["customer_id"],
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(SORT_KEYS))
def test_report_order_matches_sql(spark, con, name):
    keys = SORT_KEYS[name]
    got = [tuple(r[k] for k in keys)
           for r in registry.queries()[name](spark, SF_CHECK).orderBy("position").collect()]
    rel = con.sql(registry.oracle_sql()[name])
    idx = [rel.columns.index(k) for k in keys]
    at = rel.columns.index("position")
    want = [tuple(row[i] for i in idx) for row in sorted(rel.fetchall(), key=lambda row: row[at])]
    assert got == want
