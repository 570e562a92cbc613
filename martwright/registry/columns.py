"""Registered column-expression queries.

Each reads a whole driver table and applies one family of ``Column`` rules.
Money rules are computed in decimal and turned into double last, so both
engines give the same digits; ``pow`` results are rounded to cents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import exprs as X
from martwright.functions import sql_functions
from martwright.registry._inputs import table as read_table

# Fixed parameters of the registered queries.
GROWTH_RATE = 0.0375           # yearly rate for growth and interest
SAVINGS_GOAL = 250000         # goal for the shortfall rule
COMPARE_TO = 200000           # reference value for the comparison flags
SKIPPED_SEGMENT = "BUILDING"  # value skipped by the exclusion rule
SPECIAL_SEGMENT = "MACHINERY" # rows that get the special message
GREETING = "Dear %s, your order has been booked."
SPECIAL_GREETING = "Dear %s, your account manager will call you."


def _grade_band(spark, d):
    c = read_table(spark, d, "customer")
    score = F.col("c_acctbal") / F.lit(100)
    return c.select(F.col("c_custkey"), score.alias("score"), X.grade(score).alias("grade"))


def _ratio_band(spark, d):
    p = read_table(spark, d, "part")
    weight = F.col("p_retailprice") / F.lit(10.0)
    height_cm = F.lit(150) + F.col("p_size")
    ratio = X.mass_ratio(weight, height_cm)
    return p.select("p_partkey", ratio.alias("ratio"), X.ratio_band(ratio).alias("band"))


def _compound_growth(spark, d):
    c = read_table(spark, d, "customer")
    grown = X.compound_growth("c_acctbal", F.lit(GROWTH_RATE), F.col("c_nationkey"))
    return c.select("c_custkey", F.col("c_nationkey").alias("years"),
                    F.round(grown, 2).alias("grown"))


def _simple_interest(spark, d):
    c = read_table(spark, d, "customer")
    return c.select("c_custkey", F.col("c_nationkey").alias("years"),
                    X.simple_interest("c_acctbal", GROWTH_RATE, "c_nationkey").alias("grown"))


def _goal_shortfall(spark, d):
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey",
                    (F.col("o_totalprice") >= F.lit(SAVINGS_GOAL)).alias("reached"),
                    X.goal_shortfall("o_totalprice", SAVINGS_GOAL).alias("shortfall"))


def _equal_split(spark, d):
    """Each order's total split evenly over its lines (orders without lines: null)."""
    o = read_table(spark, d, "orders")
    lines = (read_table(spark, d, "lineitem").groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).alias("n_lines")))
    j = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    return j.select("o_orderkey", "n_lines",
                    X.equal_split("o_totalprice", "n_lines").alias("share"))


def _exclude_value(spark, d):
    c = read_table(spark, d, "customer")
    return (c.where(X.is_not_value("c_mktsegment", SKIPPED_SEGMENT))
            .select("c_custkey", "c_mktsegment"))


def _message_template(spark, d):
    c = read_table(spark, d, "customer")
    msg = X.templated_message("c_name", GREETING, SPECIAL_GREETING,
                              special_if=F.col("c_mktsegment") == F.lit(SPECIAL_SEGMENT))
    return c.select("c_custkey", msg.alias("message"))


def _string_ops(spark, d):
    c = read_table(spark, d, "customer")
    return c.select(
        "c_custkey",
        F.length("c_name").alias("name_len"),
        X.char_at("c_name", 0).alias("first_char"),
        X.char_at("c_name", 9).alias("tenth_char"),
        X.char_at("c_name", 40).alias("char_past_end"),
        X.char_at("c_name", -2).alias("second_last_char"),
        F.concat("c_mktsegment", F.lit("-"), "c_name").alias("joined"),
        F.repeat("c_mktsegment", 2).alias("doubled"),
        F.upper("c_name").alias("upper_name"))


def _compare_flags(spark, d):
    o = read_table(spark, d, "orders")
    flags = X.comparison_flags("o_totalprice", F.lit(COMPARE_TO))
    return o.select("o_orderkey", *[v.alias(f"price_{k}") for k, v in flags.items()])


def _non_empty(spark, d):
    o = read_table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        X.is_truthy_text("o_orderpriority").alias("has_priority"),
        X.is_truthy_number("o_totalprice").alias("has_price"),
        X.is_truthy_array(F.split("o_orderpriority", "-")).alias("has_parts"))


def _scalar_functions(spark, d):
    sql_functions.register_formulas(spark)
    p = read_table(spark, d, "part")
    call = sql_functions.call
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice")
    return p.select(
        "p_partkey",
        call("triangle_area", size, price).alias("triangle_area"),
        call("rectangle_area", size, price).alias("rectangle_area"),
        call("rectangle_perimeter", size, price).alias("perimeter"),
        call("box_volume", size, size, price).alias("volume"),
        call("add_two", size, price).alias("total"),
        call("origin_distance", size, price).alias("distance"),
        call("arith_term", size, F.lit(3.0), F.lit(12.0)).alias("twelfth_term"))


QUERIES = {
    "grade_band": _grade_band,
    "ratio_band": _ratio_band,
    "compound_growth": _compound_growth,
    "simple_interest": _simple_interest,
    "goal_shortfall": _goal_shortfall,
    "equal_split": _equal_split,
    "exclude_value": _exclude_value,
    "message_template": _message_template,
    "string_ops": _string_ops,
    "compare_flags": _compare_flags,
    "non_empty": _non_empty,
    "scalar_functions": _scalar_functions,
}

_SCORE = "(c_acctbal / 100)"
_H = "(CAST(150 + p_size AS DOUBLE) / 100.0)"

ORACLE = {
    "grade_band": f"""
SELECT c_custkey, {_SCORE} AS score,
       CASE WHEN {_SCORE} IS NULL THEN NULL WHEN {_SCORE} > 90 THEN 'A' WHEN {_SCORE} > 85 THEN 'AB'
            WHEN {_SCORE} > 80 THEN 'B' WHEN {_SCORE} > 75 THEN 'BC'
            WHEN {_SCORE} > 70 THEN 'C' ELSE 'D' END AS grade
FROM customer
""",
    "ratio_band": f"""
SELECT p_partkey, ratio,
       CASE WHEN ratio IS NULL THEN NULL WHEN ratio >= 25 THEN 'obese' WHEN ratio >= 23 THEN 'overweight'
            WHEN ratio >= 18.5 THEN 'normal' ELSE 'underweight' END AS band
FROM (SELECT p_partkey, (p_retailprice / 10.0) / ({_H} * {_H}) AS ratio FROM part)
""",
    "compound_growth": f"""
SELECT c_custkey, c_nationkey AS years,
       ROUND(c_acctbal * pow(CAST(1.0 AS DOUBLE) + CAST({GROWTH_RATE} AS DOUBLE), c_nationkey), 2)
         AS grown
FROM customer
""",
    "simple_interest": f"""
SELECT c_custkey, c_nationkey AS years,
       CAST(ROUND(CAST(c_acctbal AS DECIMAL(18,2))
                  * (1 + CAST({GROWTH_RATE} AS DECIMAL(9,6)) * CAST(c_nationkey AS DECIMAL(9,0))),
                  2) AS DOUBLE) AS grown
FROM customer
""",
    "goal_shortfall": f"""
SELECT o_orderkey, o_totalprice >= {SAVINGS_GOAL} AS reached,
       CASE WHEN o_totalprice >= {SAVINGS_GOAL} THEN 0.0::DOUBLE
            ELSE CAST({SAVINGS_GOAL} - CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END
         AS shortfall
FROM orders
""",
    "equal_split": """
SELECT o.o_orderkey, c.n_lines,
       CAST(trunc(o.o_totalprice / CAST(c.n_lines AS DOUBLE)) AS BIGINT) AS share
FROM orders o
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey) c
  ON o.o_orderkey = c.l_orderkey
""",
    "exclude_value": f"""
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_mktsegment IS DISTINCT FROM '{SKIPPED_SEGMENT}'
""",
    "message_template": f"""
SELECT c_custkey,
       CASE WHEN c_mktsegment = '{SPECIAL_SEGMENT}'
            THEN 'Dear ' || c_name || ', your account manager will call you.'
            ELSE 'Dear ' || c_name || ', your order has been booked.' END AS message
FROM customer
""",
    "string_ops": """
SELECT c_custkey,
       CAST(length(c_name) AS INTEGER) AS name_len,
       substring(c_name, 1, 1)  AS first_char,
       substring(c_name, 10, 1) AS tenth_char,
       substring(c_name, 41, 1) AS char_past_end,
       substring(c_name, -2, 1) AS second_last_char,
       c_mktsegment || '-' || c_name AS joined,
       repeat(c_mktsegment, 2) AS doubled,
       upper(c_name) AS upper_name
FROM customer
""",
    "compare_flags": f"""
SELECT o_orderkey,
       o_totalprice = {COMPARE_TO}  AS price_eq, o_totalprice <> {COMPARE_TO} AS price_ne,
       o_totalprice < {COMPARE_TO}  AS price_lt, o_totalprice <= {COMPARE_TO} AS price_le,
       o_totalprice > {COMPARE_TO}  AS price_gt, o_totalprice >= {COMPARE_TO} AS price_ge
FROM orders
""",
    "non_empty": """
SELECT o_orderkey,
       length(o_orderpriority) > 0 AS has_priority,
       o_totalprice <> 0 AS has_price,
       len(string_split(o_orderpriority, '-')) > 0 AS has_parts
FROM orders
""",
    "scalar_functions": """
SELECT p_partkey,
       CAST(p_size AS DOUBLE) * p_retailprice / 2 AS triangle_area,
       CAST(p_size AS DOUBLE) * p_retailprice AS rectangle_area,
       2 * (CAST(p_size AS DOUBLE) + p_retailprice) AS perimeter,
       CAST(p_size AS DOUBLE) * CAST(p_size AS DOUBLE) * p_retailprice AS volume,
       CAST(p_size AS DOUBLE) + p_retailprice AS total,
       sqrt(CAST(p_size AS DOUBLE) * CAST(p_size AS DOUBLE) + p_retailprice * p_retailprice)
         AS distance,
       CAST(p_size AS DOUBLE) + (12.0 - 1) * 3.0 AS twelfth_term
FROM part
""",
}
