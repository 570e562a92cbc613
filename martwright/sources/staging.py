"""Map arbitrary source tables onto the sales roles.

The dataset builders in :mod:`martwright.plans.datasets` take role frames with
fixed column names (``artist``, ``album``, ``track``, ``genre``,
``invoice_line``, ``invoice``, ``customer``).  A real deployment reads those
tables directly (parquet or :func:`martwright.sources.jdbc.read_jdbc_table`).
The functions here adapt the driver's TPC-H-like test tables to the same
roles while keeping the cardinality pattern of the original chains
(one-to-many at every hop, optional tail tables).  Every mapping is a
projection or a small derived table, so the role frames stay lazy and all
filters and column pruning reach the parquet scans.

Note: ``lineitem.l_extendedprice`` is already a line amount, so in the test
mapping "quantity x unit price" exercises the shape of the rule, not a
business figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values of the test mapping: the text-repair pairs used on the test
# data, where '#' plays the part of the broken character.
TEST_LAST_NAME_REPAIR = ("#", "o")
TEST_ADDRESS_REPAIR = ("#", "d")


def _id(c: str) -> F.Column:
    return F.col(c).cast("bigint")


def sales_roles(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Roles for ``sales_lines``: region/nation/supplier/lineitem/orders."""
    return {
        "artist": t["region"].select(_id("r_regionkey").alias("artist_id"),
                                     F.col("r_name").alias("name")),
        "album": t["nation"].select(_id("n_nationkey").alias("album_id"),
                                    _id("n_regionkey").alias("artist_id"),
                                    F.col("n_name").alias("title")),
        "track": t["supplier"].select(_id("s_suppkey").alias("track_id"),
                                      _id("s_nationkey").alias("album_id"),
                                      F.col("s_name").alias("name")),
        "invoice_line": t["lineitem"].select(
            _id("l_linenumber").alias("invoice_line_id"),
            _id("l_orderkey").alias("invoice_id"),
            _id("l_suppkey").alias("track_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price")),
        "invoice": t["orders"].select(_id("o_orderkey").alias("invoice_id"),
                                      _id("o_custkey").alias("customer_id"),
                                      F.col("o_totalprice").alias("total"),
                                      F.col("o_orderdate").alias("invoice_date")),
    }


def _priority_id(c: str) -> F.Column:
    return F.split_part(F.col(c), F.lit("-"), F.lit(1)).cast("bigint")


def catalog_roles(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Roles for ``catalog``: nation/customer/orders with region as the genres.

    A track's genre id is its order priority's number (1 to 5); the genre
    table has the ids 0 to 4, so the optional genre join misses for 5.
    """
    orders = t["orders"]
    return {
        "artist": t["nation"].select(_id("n_nationkey").alias("artist_id"),
                                     F.col("n_name").alias("name")),
        "album": t["customer"].select(_id("c_custkey").alias("album_id"),
                                      _id("c_nationkey").alias("artist_id"),
                                      F.col("c_name").alias("title")),
        "track": orders.select(
            _id("o_orderkey").alias("track_id"),
            _id("o_custkey").alias("album_id"),
            _priority_id("o_orderpriority").alias("genre_id"),
            F.col("o_orderstatus").alias("name"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("unit_price"),
            # size stand-in: the price in cents, an exact integer
            (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(100))
            .cast("bigint").alias("bytes")),
        "genre": t["region"].select(_id("r_regionkey").alias("genre_id"),
                                    F.col("r_name").alias("name")),
    }


def transaction_roles(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Roles for ``transactions``: part/lineitem/orders/customer(+nation, region)."""
    nation = t["nation"].select(_id("n_nationkey").alias("nation_id"),
                                _id("n_regionkey").alias("region_id"),
                                F.col("n_name").alias("country"))
    region = t["region"].select(_id("r_regionkey").alias("region_id"),
                                F.col("r_name").alias("state"))
    customer = (
        t["customer"]
        .select(_id("c_custkey").alias("customer_id"),
                F.col("c_mktsegment").alias("first_name"),
                F.col("c_name").alias("last_name"),
                F.col("c_name").alias("address"),
                F.col("c_mktsegment").alias("city"),
                F.col("c_nationkey").cast("string").alias("postal_code"),
                F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
                _id("c_nationkey").alias("nation_id"))
        .join(nation, "nation_id", "left")
        .join(region, "region_id", "left")
        .drop("nation_id", "region_id")
    )
    return {
        "track": t["part"].select(_id("p_partkey").alias("track_id"),
                                  F.col("p_name").alias("name")),
        "invoice_line": t["lineitem"].select(
            _id("l_linenumber").alias("invoice_line_id"),
            _id("l_orderkey").alias("invoice_id"),
            _id("l_partkey").alias("track_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("unit_price")),
        "invoice": t["orders"].select(_id("o_orderkey").alias("invoice_id"),
                                      _id("o_custkey").alias("customer_id"),
                                      F.col("o_totalprice").alias("total"),
                                      F.col("o_orderdate").alias("invoice_date")),
        "customer": customer,
    }


def album_roles(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The transaction roles with an album table whose ids repeat: a part's
    album id is its size, an album row is a nation under its region's number
    (several nations to a region; most sizes have no album)."""
    r = transaction_roles(t)
    return {
        **r,
        "track": t["part"].select(_id("p_partkey").alias("track_id"),
                                  _id("p_size").alias("album_id"),
                                  F.col("p_name").alias("name")),
        "album": t["nation"].select(_id("n_regionkey").alias("album_id"),
                                    F.col("n_name").alias("title")),
    }
