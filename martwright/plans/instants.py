"""Exact distinct instants that merge day by day (A4).

``count(distinct instant)`` by country needs all rows again when a day is
added.  Here each instant gets a whole number from a dictionary, once and for
good, and a country's instants are a set of bits, kept as one bitmap for each
32,768 numbers.  A new day adds its new instants to the dictionary and its own
bitmaps; two tables of bitmaps merge by OR, so the old days are not read again,
and the count stays exact.

Sizes: a bitmap is 4 KB and there is one for each (country, 32,768 instants)
that occurs; numbers are dense, so bitmaps are well filled.  Bitmaps are built
and merged by partial aggregates, so a hot country shuffles its bitmaps, not
its rows.  A country without any instant keeps a row with a count of 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.operators.positions import with_positions
from martwright.sinks.scratch import written


def code_instants(instants: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The dictionary ``instant, code`` of all that are in ``known`` or in
    ``instants`` (a column ``instant``); codes in ``known`` stay as they are.

    New instants are numbered by their order behind the highest known code.
    """
    new = instants.select("instant").where(F.col("instant").isNotNull()).distinct()
    if known is None:
        return with_positions(new, F.col("instant"), name="code")
    new = new.join(known.select("instant"), "instant", "left_anti")
    start = known.agg(F.coalesce(F.max("code"), F.lit(0))).first()[0]
    added = with_positions(new, F.col("instant"), name="code").withColumn("code", F.col("code") + F.lit(start))
    return known.unionByName(added)


def visit_bitmaps(visits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``country, bucket, bitmap`` of ``visits(country, instant)``, whose
    instants are all in ``dictionary``; countries that are null are left out."""
    each = visits.where(F.col("country").isNotNull()).select("country", "instant").distinct()
    coded = each.join(dictionary, "instant", "left")
    return (coded.groupBy("country", F.bitmap_bucket_number("code").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bitmap")))


def merge_bitmaps(*tables: DataFrame) -> DataFrame:
    """One table of bitmaps for the visits of all."""
    both = tables[0]
    for t in tables[1:]:
        both = both.unionByName(t)
    return both.groupBy("country", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def frequency(bitmaps: DataFrame) -> DataFrame:
    """Distinct instants by country: the mart of Q7."""
    return bitmaps.groupBy("country").agg(F.sum(F.bitmap_count("bitmap")).alias("frequency_level"))


def add_visits(visits: DataFrame, dictionary: DataFrame | None = None,
               bitmaps: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(dictionary, bitmaps)`` with some more visits, both written.  Reads
    the new visits and the two small tables, no former visit."""
    dictionary = written(code_instants(visits, dictionary), "instants")
    new = visit_bitmaps(visits, dictionary)
    return dictionary, written(merge_bitmaps(*([bitmaps] if bitmaps is not None else []), new), "bitmaps")
