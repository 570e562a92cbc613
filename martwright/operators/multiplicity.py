"""Joins to a table none of whose columns are used.

Such a join still repeats a row for each match.  It needs no more of the other
table than how often each key occurs, so the other side is one count for each
key, and rows are repeated where the count is above one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

_CHUNK = 1024  # repeats listed at once


def match_counts(other: DataFrame, key: str, name: str) -> DataFrame:
    """``key, name``: rows of ``other`` for each key that is not null.  Counted
    in the scan's own tasks first, so a hot key shuffles a row for each task."""
    return (other.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name)))


def with_matches(df: DataFrame, key: str, other: DataFrame, other_key: str, name: str = "_matches") -> DataFrame:
    """``df`` with the long column ``name``: how many rows a left join with
    ``other`` makes of each row (1 where nothing matches)."""
    counts = match_counts(other, other_key, name).withColumnRenamed(other_key, f"{name}_key")
    return (df.join(counts, F.col(key) == F.col(f"{name}_key"), "left")
            .withColumn(name, F.coalesce(name, F.lit(1).cast("bigint"))).drop(f"{name}_key"))


def repeated(df: DataFrame, name: str = "_matches") -> DataFrame:
    """Each row ``name`` times (at least one, null counts as one), without that
    column.

    Two nested ``explode`` make the repeats in chunks, so a row with very many
    needs no array of their number; there is no shuffle.
    """
    n = F.coalesce(F.col(name), F.lit(1).cast("bigint"))
    one = F.array(F.lit(0).cast("bigint"))
    chunks = F.when(n > 1, F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / _CHUNK))).otherwise(one)
    last = F.least(F.lit(_CHUNK).cast("bigint"), n - F.col(f"{name}_chunk") * _CHUNK)
    within = F.when(n > 1, F.sequence(F.lit(1).cast("bigint"), last)).otherwise(one)
    return (df.withColumn(f"{name}_chunk", F.explode(chunks)).withColumn(f"{name}_at", F.explode(within))
            .drop(name, f"{name}_chunk", f"{name}_at"))
