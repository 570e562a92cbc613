"""Table readers for the registered queries.

Each call opens the folder anew: a replaced folder is read as it is now.  A
:class:`~martwright.sources.tables.TableSet` opens a table when it is first used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martwright.sources.tables import TableSet, read_parquet_tables


def tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return read_parquet_tables(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables(spark, sf_dir)[name]


def roles(spark: SparkSession, sf_dir: str,
          stage: Callable[[TableSet], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Staged role frames."""
    return stage(tables(spark, sf_dir))
