"""Declared schemas of the published datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


SALES_LINES = _schema(
    ("artist_id", LongType()), ("track_id", LongType()),
    ("invoice_line_id", LongType()), ("invoice_id", LongType()),
    ("artist_name", StringType()), ("album_title", StringType()),
    ("song_title", StringType()), ("total_price", DoubleType()),
    ("invoice_date", TimestampNTZType()))

CATALOG = _schema(
    ("artist_id", LongType()), ("album_id", LongType()),
    ("track_id", LongType()), ("genre_id", LongType()),
    ("artist_name", StringType()), ("album_title", StringType()),
    ("song_title", StringType()), ("genre_name", StringType()),
    ("unit_price", DoubleType()), ("bytes", LongType()))

TRANSACTIONS = _schema(
    ("customer_id", LongType()), ("track_id", LongType()),
    ("invoice_id", LongType()), ("full_name", StringType()),
    ("address", StringType()), ("city", StringType()), ("state", StringType()),
    ("country", StringType()), ("postal_code", StringType()),
    ("email", StringType()), ("total", DoubleType()),
    ("invoice_date", TimestampNTZType()))

DATASET_SCHEMAS: dict[str, StructType] = {
    "sales_lines": SALES_LINES,
    "catalog": CATALOG,
    "transactions": TRANSACTIONS,
}


def name_by_position(df: DataFrame, names: list[str]) -> DataFrame:
    """Give a result's columns their names by position (S3), as a result set
    fetched without names is labelled.  The count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, {len(names)} names")
    return df.toDF(*names)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Reorder columns by name and cast to the declared types.

    ``DataFrame.to`` only allows safe casts, so a wrong source type (for
    example a string where a number is declared) raises at analysis time
    instead of loading bad rows.  A declared column that is missing raises
    (``to`` alone would fill in nulls); columns beyond the declared ones are
    left out.  Column metadata a source attached (JDBC adds some) is replaced by the declared
    one, so the result has exactly the declared schema.
    """
    there = {c.lower() for c in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in there]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    shaped = df.to(schema)
    return shaped.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) for f in schema])
