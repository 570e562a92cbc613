"""Global row positions: the order of a report as a column.

An ``ORDER BY`` is lost when its rows are stored or compared as a set.
``with_positions`` numbers the rows 1, 2, 3, ... in a given order.  A window
without partition keys would do that in a single task; here the rows are range
partitioned and sorted (Spark's own global sort), each row keeps its partition
and its place there, and a partition's rows start after the sum of the counts
of the partitions before it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from martwright.sinks.scratch import written

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place below


def with_positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with the long column ``name``: each row's place by ``order``.

    Equal rows by ``order`` get different positions, in no fixed order; give
    a total order where that matters (it also lets the ranges split a hot key).
    An empty table gives an empty one; ``name`` must not be a column of ``df``.

    The sorted rows are written once to the shared folder: the ranges come from
    a sample, so counting and numbering must see the same partitions.  Only
    the count of each partition reaches the driver (one number for each
    shuffle partition, whatever the number of rows).
    """
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {name!r}")
    if not order:
        raise ValueError("give at least one sort column")
    at = "_place"
    while at.lower() in (c.lower() for c in (*df.columns, name)):
        at += "_"
    rows = written(df.orderBy(*order).withColumn(at, F.monotonically_increasing_id()), "positions")
    part = F.shiftright(F.col(at), _PLACE_BITS)
    counts = sorted((r[0], r[1]) for r in rows.groupBy(part).count().collect())
    starts = dict(zip((p for p, _ in counts), accumulate((n for _, n in counts), initial=0)))
    # the partition numbers are dense up to the shuffle width: a list of starts
    # indexed by them is a literal of that size
    dense = [starts.get(p, 0) for p in range(max(starts, default=0) + 1)]
    start = F.element_at(F.lit(dense).cast("array<bigint>"), (part + 1).cast("int"))
    place = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return rows.withColumn(name, start + place + 1).drop(at)
