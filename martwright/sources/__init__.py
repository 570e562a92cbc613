"""Readers: parquet tables, JDBC tables, and the test-table staging step."""

from martwright.sources.jdbc import read_jdbc_table
from martwright.sources.staging import album_roles, catalog_roles, sales_roles, transaction_roles
from martwright.sources.tables import TEST_TABLES, read_parquet_tables, read_published, read_table

__all__ = [
    "TEST_TABLES",
    "album_roles",
    "catalog_roles",
    "read_jdbc_table",
    "read_parquet_tables",
    "read_published",
    "read_table",
    "sales_roles",
    "transaction_roles",
]
