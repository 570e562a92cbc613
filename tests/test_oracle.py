"""Every registered query against its SQL oracle in DuckDB (sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from martwright import registry
from martwright.sources.tables import TEST_TABLES
from scripts.oracle_check import _digest, _duck_rows, _spark_rows

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    scols, srows = _spark_rows(QUERIES[name](spark, SF_SMALL))
    dcols, drows = _duck_rows(con, ORACLE[name])
    assert scols == dcols
    assert len(srows) == len(drows)
    assert _digest(srows, None) == _digest(drows, None)


def test_the_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["artist_name", "total_revenue"]
    assert len(rows) > 0
