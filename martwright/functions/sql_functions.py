"""Named scalar formulas as SQL functions (R28), and SQL functions that give
rows (R21, R23).

``CREATE TEMPORARY FUNCTION ... RETURN <expr>`` defines a SQL function whose
body Catalyst inlines into the calling plan: it is an ordinary expression
after analysis (whole-stage codegen, no Python worker), unlike a Python UDF.
The same formulas are also offered as ``Column`` builders for DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# name -> (parameter list, body)
FORMULAS: dict[str, tuple[str, str]] = {
    "triangle_area": ("base DOUBLE, height DOUBLE", "base * height / 2"),
    "rectangle_area": ("length DOUBLE, width DOUBLE", "length * width"),
    "rectangle_perimeter": ("length DOUBLE, width DOUBLE", "2 * (length + width)"),
    "box_volume": ("length DOUBLE, width DOUBLE, height DOUBLE", "length * width * height"),
    "add_two": ("x DOUBLE, y DOUBLE", "x + y"),
    "origin_distance": ("x DOUBLE, y DOUBLE", "sqrt(x * x + y * y)"),
    "arith_term": ("first DOUBLE, step DOUBLE, n DOUBLE", "first + (n - 1) * step"),
}


# Functions that give rows: name -> (parameter list, columns, query).  The
# body is one generator over the arguments, so a lateral call is planned as that
# generator behind the outer table, with no join.
TABLE_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "word_rows": ("line STRING", "pos INT, word STRING", "SELECT pos, col FROM posexplode(split(line, ' '))"),
    "pair_rows": ("m MAP<STRING, STRING>", "name STRING, item STRING", "SELECT key, value FROM explode(m)"),
    "zipped_rows": ("a ARRAY<STRING>, b ARRAY<STRING>", "first STRING, second STRING",
                    "SELECT * FROM inline(arrays_zip(coalesce(a, array()), coalesce(b, array())))"),
}


def register_table_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL table functions in this session."""
    for name, (params, columns, query) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS TABLE({columns}) RETURN {query}")
    return list(TABLE_FUNCTIONS)


def register_formulas(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions in this session, once."""
    if getattr(spark, "_martwright_formulas", False):
        return list(FORMULAS)
    for name, (params, body) in FORMULAS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS DOUBLE RETURN {body}")
    spark._martwright_formulas = True
    return list(FORMULAS)


def call(name: str, *args: Column | str) -> Column:
    """Call a registered formula from the DataFrame API."""
    cols = [a if isinstance(a, Column) else F.col(a) for a in args]
    return F.call_function(name, *cols)
