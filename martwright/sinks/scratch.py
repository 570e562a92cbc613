"""Intermediate tables in the shared checkpoint folder.

``written`` cuts the lineage of a DataFrame at a Parquet table that every
executor can read, so a lost executor costs no step before it.  The tables of
a session lie in one folder; ``clean`` removes it when the results that were
read from them are stored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martwright.session import checkpoint_dir


def scratch_dir(spark: SparkSession) -> str:
    """The session's own folder for intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/martwright-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below :func:`scratch_dir` and read back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A catalog name for an intermediate table of this session (bucketed
    tables are known by name only)."""
    app = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    return f"martwright_{app}_{name}".lower()


def clean(spark: SparkSession) -> bool:
    """Remove the session's intermediate tables; true if there were any.
    DataFrames that still read them can't be evaluated any more."""
    for t in spark.catalog.listTables(pattern=f"{scratch_table(spark, '')}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.delete(at, True)
