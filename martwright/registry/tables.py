"""Registered table-operator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright import operators as O
from martwright.functions.exprs import PASS_MARK
from martwright.registry._inputs import table as read_table

# Fixed parameters: the event that ends a take-until scan and the event whose
# share is measured.
STOP_EVENT = "purchase"
SHARE_EVENTS = ("purchase", "signup")


def _events(spark, d):
    return read_table(spark, d, "events")


def _threshold_summary(spark, d):
    return O.threshold_summary(_events(spark, d), "user_id", "value", PASS_MARK)


def _threshold_rows(spark, d):
    return (O.rows_at_or_below(_events(spark, d), "value", PASS_MARK)
            .select("event_id", "user_id", "value"))


def _distinct_values(spark, d):
    return O.distinct_values(read_table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def _append_rows(spark, d):
    cust = read_table(spark, d, "customer").select(
        F.col("c_custkey").alias("party_id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_mktsegment").alias("segment"),
        F.lit("customer").alias("kind"))
    supp = read_table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("party_id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"), F.lit("supplier").alias("kind"))
    return O.append_rows(cust, supp)


def _neighbour_diff(spark, d):
    e = _events(spark, d).select("event_id", "user_id", "ts", "value")
    return O.neighbour_diff(e, "user_id", "ts", "event_id", "value")


def _event_share(spark, d):
    e = _events(spark, d)
    return O.event_share(e, "user_id", F.col("event_type").isin(list(SHARE_EVENTS)),
                         name="share")


def _take_until(spark, d):
    e = _events(spark, d).select("event_id", "user_id", "ts", "event_type")
    return O.take_until(e, "user_id", ["ts", "event_id"], F.col("event_type") == F.lit(STOP_EVENT))


def _record_count(spark, d):
    return O.record_count(_events(spark, d), "event_type")


QUERIES = {
    "threshold_summary": _threshold_summary,
    "threshold_rows": _threshold_rows,
    "distinct_values": _distinct_values,
    "append_rows": _append_rows,
    "neighbour_diff": _neighbour_diff,
    "event_share": _event_share,
    "take_until": _take_until,
    "record_count": _record_count,
}

_SHARE_LIST = ", ".join(f"'{e}'" for e in SHARE_EVENTS)

ORACLE = {
    "threshold_summary": f"""
SELECT user_id,
       CAST(count(*) FILTER (WHERE value <= {PASS_MARK}) AS BIGINT) AS n_at_or_below,
       CAST(count(*) FILTER (WHERE value > {PASS_MARK}) AS BIGINT) AS n_above,
       max(CASE WHEN value <= {PASS_MARK} THEN value END) AS max_at_or_below
FROM events GROUP BY user_id
""",
    "threshold_rows": f"""
SELECT event_id, user_id, value FROM events WHERE value <= {PASS_MARK}
""",
    "distinct_values": """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders
""",
    "append_rows": """
SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation_id,
       c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, CAST(NULL AS VARCHAR), 'supplier' FROM supplier
""",
    "neighbour_diff": """
SELECT event_id, user_id, ts, value, prev_value, value - prev_value AS diff
FROM (SELECT event_id, user_id, ts, value,
             lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_value
      FROM events)
""",
    "event_share": f"""
SELECT user_id, avg(CASE WHEN event_type IN ({_SHARE_LIST}) THEN 1.0 ELSE 0.0 END)::DOUBLE AS share
FROM events GROUP BY user_id
""",
    "take_until": f"""
WITH stops AS (
  SELECT user_id, ts AS stop_ts, event_id AS stop_id
  FROM (SELECT user_id, ts, event_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
        FROM events WHERE event_type = '{STOP_EVENT}')
  WHERE rn = 1
)
SELECT e.event_id, e.user_id, e.ts, e.event_type
FROM events e LEFT JOIN stops s ON e.user_id IS NOT DISTINCT FROM s.user_id
WHERE s.stop_ts IS NULL OR e.ts < s.stop_ts OR (e.ts = s.stop_ts AND e.event_id <= s.stop_id)
""",
    "record_count": """
SELECT event_type, count(*) AS n_records FROM events GROUP BY event_type
""",
}
