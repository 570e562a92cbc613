"""Parquet table readers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from martwright.sinks.publish import current_version

# The driver's test tables, one parquet file (or folder) each.
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Read ``{base_dir}/{name}.parquet`` (file or folder), else ``{base_dir}/{name}``.

    Spark looks for the path, so any file system it knows will do.
    """
    path = f"{base_dir.rstrip('/')}/{name}"
    try:
        return spark.read.parquet(f"{path}.parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.read.parquet(path)


class TableSet(Mapping[str, DataFrame]):
    """Table name -> DataFrame, opened on first use.

    ``spark.read.parquet`` lists files and reads a footer as soon as it is
    called, so a query should only open the tables it uses.
    """

    def __init__(self, spark: SparkSession, base_dir: str, names: Iterable[str]):
        self._spark, self._dir, self._names = spark, base_dir, list(names)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = read_table(self._spark, self._dir, name)
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_parquet_tables(
    spark: SparkSession, base_dir: str, names: Iterable[str] | None = None
) -> TableSet:
    """Readers for several tables; each is opened when first used and nothing
    is scanned until an action."""
    return TableSet(spark, base_dir, names or TEST_TABLES)


def read_published(spark: SparkSession, *, path: str | None = None, table: str | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """Read a dataset written by :func:`martwright.sinks.publish` (S6), the
    current version where it has versions."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if table is not None:
        return spark.table(table)
    return spark.read.format(fmt).load(current_version(spark, path))
