"""Full-replace publishing.

``publish`` leaves the target holding exactly this result, as the warehouse's
truncate-and-load did, but writes the new version beside the old one first and
swaps the two by renaming only when it is complete.  A write that fails leaves
the old table as it was.  The write is distributed (every task writes its own
files) and rows never pass through the driver.

The swap is two renames (old aside, new in place), undone if the second fails;
a reader that opens the table between them finds none and has to try again.

``versioned=True`` has no such gap.  A path then holds a numbered folder for
each version and an empty marker file for each complete one; a new version is
written beside the others, and creating its marker makes it the table.
``read_published`` takes the version of the highest marker.  Nothing is renamed
or overwritten, so this needs no more than that a file appears at once, which
object stores give too.  For a catalog table the versions lie in an external
folder and one change of its location switches them.  Readers that have opened a
former version keep it: the last ``keep`` versions stay, older ones are removed.
Publish a table from one job at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def publish(df: DataFrame, *, path: str | None = None, table: str | None = None,
            fmt: str = "parquet", partition_by: Sequence[str] = (),
            options: dict[str, str] | None = None, versioned: bool = False, keep: int = 2) -> str:
    """Replace ``path`` or catalog ``table`` with ``df``; returns the target."""
    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if keep < 1:
        raise ValueError("the current version has to stay")
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if options:
        writer = writer.options(**options)
    version = uuid.uuid4().hex
    if versioned:
        spark = df.sparkSession
        base = path.rstrip("/") if path else versions_of_table(spark, table)
        name = f"v{_next_number(spark, base):012d}-{version}"
        writer.save(f"{base}/{name}")
        if table is not None:
            _relocate(spark, table, f"{base}/{name}", fmt)
        _mark(spark, base, name)
        _expire(spark, base, keep)
        return path or table
    if table is not None:
        writer.saveAsTable(f"{table}__new_{version}")
        _swap_table(df.sparkSession, table, version)
        return table
    target = path.rstrip("/")
    writer.save(f"{target}__new_{version}")
    _swap_path(df.sparkSession, target, version)
    return path


def _swap_path(spark: SparkSession, target: str, version: str) -> None:
    jvm = spark.sparkContext._jvm
    at, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (
        target, f"{target}__new_{version}", f"{target}__old_{version}"))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = fs.exists(at)
    if there and not fs.rename(at, old):
        raise OSError(f"{target} can't be set aside; the new version is {new}")
    if not fs.rename(new, at):
        if there:
            fs.rename(old, at)
        raise OSError(f"{new} can't be put in place of {target}")
    if there:
        fs.delete(old, True)
    spark.catalog.refreshByPath(target)


def _swap_table(spark: SparkSession, table: str, version: str) -> None:
    new, old = f"{table}__new_{version}", f"{table}__old_{version}"
    there = spark.catalog.tableExists(table)
    if there:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    except Exception:
        if there:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if there:
        spark.sql(f"DROP TABLE {old}")


# --- versions ------------------------------------------------------------------

MARK = "_COMPLETE-"  # Spark's readers skip names that begin with an underscore


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions_of_table(spark: SparkSession, table: str) -> str:
    """The folder of a versioned catalog table's versions, beside the warehouse's own tables."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '/')}__versions"


def _names(spark: SparkSession, base: str) -> list[str]:
    at, fs = _fs(spark, base)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def _is_version(name: str) -> bool:
    return name[:1] == "v" and name[1:13].isdigit()


def _next_number(spark: SparkSession, base: str) -> int:
    return max((int(n[1:13]) for n in _names(spark, base) if _is_version(n)), default=0) + 1


def _mark(spark: SparkSession, base: str, name: str) -> None:
    """Version ``name`` is complete: readers take it from now on."""
    at, fs = _fs(spark, f"{base}/{MARK}{name}")
    fs.create(at, False).close()


def complete_versions(spark: SparkSession, base: str) -> list[str]:
    """Names of the versions that have a marker, the current one last."""
    return sorted(n[len(MARK):] for n in _names(spark, base) if n.startswith(MARK))


def current_version(spark: SparkSession, path: str) -> str:
    """The folder to read for a published path: its current version, or the
    path itself where it has no versions."""
    base = path.rstrip("/")
    names = complete_versions(spark, base)
    return f"{base}/{names[-1]}" if names else path


def _relocate(spark: SparkSession, table: str, folder: str, fmt: str) -> None:
    """Let ``table`` read ``folder``: created there, or moved there by one
    change in the catalog.  The columns have to be those it had."""
    at, fs = _fs(spark, folder)
    where = fs.makeQualified(at).toString()
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=where, source=fmt)
        return
    now = spark.read.format(fmt).load(folder).schema
    if [(f.name, f.dataType) for f in now] != [(f.name, f.dataType) for f in spark.table(table).schema]:
        raise ValueError(f"{table} has other columns; drop it before publishing these")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{where}'")
    spark.catalog.refreshTable(table)


def _expire(spark: SparkSession, base: str, keep: int) -> None:
    """Remove what is older than the last ``keep`` complete versions, markers
    first; among it what failed writes have left."""
    oldest = complete_versions(spark, base)[-keep:][0]
    names = _names(spark, base)
    for name in ([n for n in names if n.startswith(MARK) and n[len(MARK):] < oldest]
                 + [n for n in names if _is_version(n) and n < oldest]):
        at, fs = _fs(spark, f"{base}/{name}")
        fs.delete(at, True)
