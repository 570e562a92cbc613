"""Relational source over JDBC.

The reference pulls a whole query result through one cursor into one process.
Here the read is split into ``num_partitions`` range slices of a numeric key,
each fetched by its own task, so no single process ever holds the table.
Connection details (URL, user, secret) always come from the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
    prefer_timestamp_ntz: bool = True,
    balanced: bool = False,
    as_of: str | None = None,
) -> DataFrame:
    """Read ``table`` (a table name or a parenthesised sub-query with alias).

    With ``partition_column`` and ``num_partitions`` the read is parallel.  The
    bounds only shape the slices (rows outside them still land in the first
    or last slice); when they are not given they are looked up with one
    ``min``/``max`` query that the database answers, a single row.

    ``partition_column`` may be given plainly (matched to the table's columns
    without regard to case, as Spark does) or already quoted.

    Slices of equal key ranges hold very different numbers of rows where ids
    are not spread evenly.  ``balanced`` cuts the range by row counts instead
    (see :func:`balanced_slices`).

    Parallel slices are separate connections, so they do not share one
    snapshot.  With ``balanced`` all slices have the same mark: keys up to the
    highest one found before the read, so rows that arrive later under higher
    ids are in no slice.  ``as_of`` is a further condition in the database's SQL
    that holds in every slice, such as ``updated_at <= TIMESTAMP '...'``.
    """
    # timestamps without a zone (the source's DATETIME) stay TIMESTAMP_NTZ
    options = {"url": url, "dbtable": table, "fetchsize": str(fetchsize),
               "preferTimestampNTZ": str(prefer_timestamp_ntz).lower()}
    options.update(properties or {})
    reader = spark.read.format("jdbc").options(**options)
    if balanced:
        if not (partition_column and num_partitions):
            raise ValueError("balanced slices need partition_column and num_partitions")
        slices = balanced_slices(spark, options, table, partition_column, num_partitions, as_of)
        own = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=slices, properties=own)
    if as_of:
        options["dbtable"] = f"(SELECT * FROM {table} WHERE {as_of}) marked"
        table = options["dbtable"]
        reader = spark.read.format("jdbc").options(**options)
    if partition_column and num_partitions and num_partitions > 1:
        if lower_bound is None or upper_bound is None:
            lower_bound, upper_bound = _key_bounds(spark, options, table, partition_column)
        if lower_bound is None:  # empty table: one slice is enough
            return reader.load()
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound + 1),
            numPartitions=str(num_partitions),
        )
    return reader.load()


def _quoted(spark: SparkSession, options: dict[str, str], key: str) -> str:
    """The key column as the database must see it in a hand-written query.

    The stored name is taken from the table's schema (Spark reads it with a
    zero-row query) and quoted: backticks for MySQL-family URLs, standard
    double quotes elsewhere.
    """
    if key[:1] in ('"', "`", "["):
        return key
    names = spark.read.format("jdbc").options(**options).load().columns
    stored = next((n for n in names if n.lower() == key.lower()), key)
    if options["url"].startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        return f"`{stored}`"
    return '"' + stored.replace('"', '""') + '"'


def _key_bounds(spark: SparkSession, options: dict[str, str], table: str, key: str):
    col = _quoted(spark, options, key)
    bounds_query = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table}) b"
    opts = dict(options, dbtable=bounds_query)
    row = spark.read.format("jdbc").options(**opts).load().first()
    if row is None or row[0] is None:
        return None, None
    return int(row[0]), int(row[1])


BUCKETS = 1024  # ranges counted by one query


def _counts(spark: SparkSession, options: dict[str, str], table: str, col: str, low: int, high: int,
            where: str) -> list[tuple[int, int, int]]:
    """``(low, high, rows)`` of up to ``BUCKETS`` equal ranges of [low, high]
    that hold rows; the database groups, and only the counts are read."""
    width = -(-(high - low + 1) // BUCKETS)
    query = (f"(SELECT b, COUNT(*) AS n FROM (SELECT ({col} - {low}) / {width} AS b FROM {table} "
             f"WHERE {col} >= {low} AND {col} <= {high}{where}) k GROUP BY b) c")
    rows = spark.read.format("jdbc").options(**dict(options, dbtable=query)).load().collect()
    found: dict[int, int] = {}
    for b, n in rows:  # a database may divide whole numbers with a fraction
        found[int(b)] = found.get(int(b), 0) + int(n)
    return [(low + b * width, min(high, low + (b + 1) * width - 1), n) for b, n in sorted(found.items())]


def balanced_slices(spark: SparkSession, options: dict[str, str], table: str, key: str, slices: int,
                    as_of: str | None = None) -> list[str]:
    """Conditions that cut ``table`` into about ``slices`` parts of equal rows.

    The database counts the rows in equal ranges of the key, and again inside
    each range with more than its share, until a range is small enough or a single
    key; neighbouring ranges are then joined up to the share.  What is read is
    at most ``BUCKETS`` counts for each of these queries.  Null keys are a slice
    of their own.  The key has to be a whole number.
    """
    col = _quoted(spark, options, key)
    where = f" AND ({as_of})" if as_of else ""
    only = f" WHERE {as_of}" if as_of else ""
    query = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi, COUNT({col}) AS n FROM {table}{only}) b"
    low, high, n = spark.read.format("jdbc").options(**dict(options, dbtable=query)).load().first()
    parts = [f"{col} IS NULL{where}"]
    if low is None:
        return parts
    share = max(1, -(-int(n) // slices))
    todo, fine = [(int(low), int(high), int(n))], []
    while todo:
        a, b, rows = todo.pop()
        if rows <= share or a == b:
            fine.append((a, b, rows))
        else:
            todo += _counts(spark, options, table, col, a, b, where)
    # ranges without rows now may get some before the slices are read: cover them
    fine.sort()
    start, held = int(low), 0
    for a, _, rows in fine:
        if held and held + rows > share:
            parts.append(f"{col} >= {start} AND {col} < {a}{where}")
            start, held = a, 0
        held += rows
    parts.append(f"{col} >= {start} AND {col} <= {int(high)}{where}")
    return parts
