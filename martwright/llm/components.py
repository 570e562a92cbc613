"""Connected components of a link table, for the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.llm.common import stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step: link the larger (or the smaller) neighbours of each node, and
    the node itself, to the smallest of them.  ``pairs``: low < high."""
    up = pairs.select(F.col("low").alias("node"), F.col("high").alias("other"))
    down = pairs.select(F.col("high").alias("node"), F.col("low").alias("other"))
    both = up.union(down) if large else down
    least = both.groupBy("node").agg(F.min("other").alias("least")).select(
        "node", F.least("node", "least").alias("least"))
    moved = both.join(least, "node")
    if large:
        moved = moved.where(F.col("other") > F.col("node")).select(F.col("least").alias("low"), F.col("other").alias("high"))
    else:
        moved = (moved.select(F.col("least").alias("low"), F.col("other").alias("high"))
                 .union(least.select(F.col("least").alias("low"), F.col("node").alias("high"))))
    return moved.where(F.col("low") < F.col("high")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``links(low, high)``, low < high -> ``(low, high)``: each node but the
    smallest of its component, with that smallest node.

    Alternating large and small stars end in stars after O(log^2 n) rounds,
    in practice two to five.  A star step counts minima before it joins, and
    the join is one that AQE splits, so a node with very many links is no hot
    task.  Each round is written to the shared folder; only a count and a
    checksum reach the driver.
    """
    pairs, before = stored(links.distinct(), "links"), None
    while True:
        now = tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high"))).first())
        if now == before or not now[0]:
            return pairs
        before = now
        pairs = stored(_star(_star(pairs, True), False), "links")
