"""Table-level operators.

Scale rules followed here:

* No operator collects a group of rows into one array or one task: a group
  may hold a third of the table.  Threshold summaries return counts, the
  matching rows stay rows.
* Aggregations are decomposable (count, sum, min, max, max_by), so Spark
  pre-aggregates in every map task before the shuffle.
* Ordered per-key scans avoid one window over a whole key.  ``take_until``
  is an aggregate plus a join; ``neighbour_diff`` windows over
  (key, time chunk) and stitches chunk borders from a per-chunk summary, so
  a hot key is spread over its chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from martwright.functions.exprs import PASS_MARK


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def threshold_summary(df: DataFrame, group_cols: str | Sequence[str], value_col: str,
                      threshold: float = PASS_MARK) -> DataFrame:
    """Per group: how many values are at or below ``threshold`` and how many
    above, plus the highest value at or below it (R9)."""
    v = F.col(value_col)
    at_or_below = v <= F.lit(threshold)
    return (df.groupBy(*_cols(group_cols))
            .agg(F.count_if(at_or_below).cast("bigint").alias("n_at_or_below"),
                 F.count_if(v > F.lit(threshold)).cast("bigint").alias("n_above"),
                 F.max(F.when(at_or_below, v)).alias("max_at_or_below")))


def rows_at_or_below(df: DataFrame, value_col: str, threshold: float = PASS_MARK) -> DataFrame:
    """Which rows are at or below the threshold: a filter, kept as rows."""
    return df.where(F.col(value_col) <= F.lit(threshold))


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Distinct value combinations (R10); partial aggregation before the shuffle."""
    return df.select(*_cols(cols)).distinct()


def append_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Append rows by column name (R24); columns missing on one side are null."""
    out = first
    for o in others:
        out = out.unionByName(o, allowMissingColumns=True)
    return out


def record_count(df: DataFrame, group_cols: str | Sequence[str] = ()) -> DataFrame:
    """Number of rows, overall or per group."""
    g = _cols(group_cols) if group_cols else []
    if not g:
        return df.agg(F.count(F.lit(1)).alias("n_records"))
    return df.groupBy(*g).agg(F.count(F.lit(1)).alias("n_records"))


def event_share(df: DataFrame, group_cols: str | Sequence[str], event: Column,
                name: str = "share") -> DataFrame:
    """``n(A) / n(S)`` per group: the fraction of rows for which ``event`` holds.

    A null ``event`` counts as not happening.
    """
    hit = F.coalesce(event, F.lit(False)).cast("double")
    return df.groupBy(*_cols(group_cols)).agg(F.avg(hit).alias(name))


def _order_key(order_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order_cols])


def take_until(df: DataFrame, key: str, order_cols: Sequence[str], stop: Column) -> DataFrame:
    """Rows of each key, in order, up to and including the first row where
    ``stop`` holds; all rows of a key that never stops (R27).

    Plan: a min-aggregate finds each key's first stop (pre-aggregated in every
    map task), then a join on the key keeps the rows at or before it.  No
    window, so no task has to hold or sort a whole key; the join's skewed
    partitions are split by AQE.  ``order_cols`` must make the order total.
    """
    order_cols = list(order_cols)
    stops = (df.where(stop)
             .groupBy(F.col(key).alias("_stop_key"))
             .agg(F.min(_order_key(order_cols)).alias("_first_stop")))
    # null-safe key match: a null key is one group, as in a window
    return (df.join(stops, F.col(key).eqNullSafe(F.col("_stop_key")), "left")
            .where(F.col("_first_stop").isNull() | (_order_key(order_cols) <= F.col("_first_stop")))
            .drop("_stop_key", "_first_stop"))


def neighbour_diff(df: DataFrame, key: str, ts_col: str, tie_col: str, value_col: str,
                   chunk_unit: str = "hour", prev_name: str = "prev_value",
                   diff_name: str = "diff") -> DataFrame:
    """``U(n) - U(n-1)`` within each key, ordered by (ts, tie).

    The first row of a key has no previous value (null).  Two-level plan:

    1. window ``lag`` inside (key, time chunk) -- the chunk is
       ``date_trunc(chunk_unit, ts)``, so a hot key is split over its chunks;
    2. a per-(key, chunk) summary holds each chunk's last value (``max_by``,
       partially aggregated), and ``lag`` over that small table gives every
       chunk the last value of the key's previous non-empty chunk;
    3. a join on (key, chunk) fills the first row of each chunk.

    ``(ts, tie)`` must order the rows of a key totally.  The key is wrapped in
    a struct, which is never null itself, so windows, aggregate and join use
    the same plain keys and the rows are shuffled once.
    """
    v = F.col(value_col)
    chunk = F.date_trunc(chunk_unit, F.col(ts_col))
    base = df.withColumn("_chunk", F.struct(chunk.alias("at"))).withColumn("_key", F.struct(F.col(key).alias("k")))
    w_in = Window.partitionBy("_key", "_chunk").orderBy(ts_col, tie_col)
    d = (base.withColumn("_prev_in", F.lag(v).over(w_in))
             .withColumn("_rn", F.row_number().over(w_in)))
    tails = (base.groupBy("_key", "_chunk")
             .agg(F.max_by(v, F.struct(F.col(ts_col), F.col(tie_col))).alias("_last")))
    w_chunks = Window.partitionBy("_key").orderBy("_chunk")
    tails = (tails.withColumn("_prev_chunk_last", F.lag("_last").over(w_chunks))
             .select(F.col("_key").alias("_tail_key"), F.col("_chunk").alias("_tail_chunk"),
                     "_prev_chunk_last"))
    out = d.join(tails, (F.col("_key") == F.col("_tail_key"))
                 & (F.col("_chunk") == F.col("_tail_chunk")), "left")
    prev = F.when(F.col("_rn") == 1, F.col("_prev_chunk_last")).otherwise(F.col("_prev_in"))
    return (out.withColumn(prev_name, prev)
            .withColumn(diff_name, v - F.col(prev_name))
            .drop("_key", "_chunk", "_prev_in", "_rn", "_tail_key", "_tail_chunk", "_prev_chunk_last"))
