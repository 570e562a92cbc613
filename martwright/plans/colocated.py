"""Line and invoice tables that join without a shuffle.

Both datasets join the line table, by far the largest, with the invoices on the
invoice key.  ``publish_line_tables`` stores both sides once, bucketed and
sorted by that key with the same number of buckets; every later join reads
bucket by bucket and exchanges neither side, however large the tables are.

A bucket is read by one task, so a key that holds a large share of the lines
must not go into one: lines of heavy invoices (``operators.skew.heavy_keys``)
are kept in a table of their own, unbucketed, and joined by a salted join with
the few invoice rows of their keys.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from martwright.functions.exprs import line_total
from martwright.operators.skew import SHARE, heavy_keys, salted_join
from martwright.plans import datasets
from martwright.plans.schemas import SALES_LINES, TRANSACTIONS, conform
from martwright.sinks.scratch import scratch_dir, scratch_table

BUCKET_BYTES = 128 << 20  # of the line table as Spark estimates it, in one bucket


def bucket_count(lines: DataFrame, each: int = BUCKET_BYTES) -> int:
    """Buckets for about ``each`` bytes of lines, by Spark's own estimate of
    the table's size, a power of two, one for each core at least."""
    size = int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = max(lines.sparkSession.sparkContext.defaultParallelism, -(-size // each))
    return 1 << (wanted - 1).bit_length()


@dataclass(frozen=True)
class LineTables:
    """The published tables: bucketed lines and invoices, and the lines of
    heavy keys with these keys."""

    lines: DataFrame
    invoices: DataFrame
    heavy_lines: DataFrame | None
    heavy: tuple
    key: str

    def joined(self) -> DataFrame:
        """``lines left join invoices`` on the key."""
        out = self.lines.join(self.invoices, self.key, "left")
        if self.heavy_lines is None:
            return out
        few = self.invoices.where(F.col(self.key).isin(*self.heavy))
        return out.unionByName(salted_join(self.heavy_lines, few, self.key, "left"))


def publish_line_tables(lines: DataFrame, invoices: DataFrame, key: str = "invoice_id",
                        buckets: int | None = None, base_path: str | None = None,
                        share: float = SHARE) -> LineTables:
    """Store both sides bucketed by ``key`` and return them as read back.

    Rows are dealt to the buckets' tasks before the write, so a bucket is one
    file and is sorted.  Lines with a null key join with nothing; they are dealt
    over all buckets' tasks by the rest of the row and stay (left join).
    ``base_path`` is a folder that all executors share (default: the session's
    scratch folder, see ``sinks.clean``).
    """
    spark = lines.sparkSession
    n = buckets or bucket_count(lines)
    base = (base_path or scratch_dir(spark)).rstrip("/")
    version = uuid.uuid4().hex
    heavy, _ = heavy_keys(lines, key, share)

    def bucketed(df: DataFrame, role: str) -> DataFrame:
        table = scratch_table(spark, f"{role}_{version}")
        (df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
         .option("path", f"{base}/{role}-{version}").saveAsTable(table))
        return spark.table(table)

    apart = F.coalesce(F.col(key).isin(*heavy), F.lit(False)) if heavy else None
    heavy_lines = None
    if heavy:
        path = f"{base}/heavy-{version}"
        lines.where(apart).write.parquet(path)
        heavy_lines = spark.read.parquet(path)
        lines = lines.where(~apart)
    return LineTables(bucketed(lines, "lines"), bucketed(invoices, "invoices"), heavy_lines, tuple(heavy), key)


def sales_lines(artist: DataFrame, album: DataFrame, track: DataFrame, tables: LineTables) -> DataFrame:
    """Q1 on published tables.  The invoice join comes first, where the lines
    lie; the line side is then only read by the star joins, which broadcast
    small dimensions."""
    dated = tables.joined().where(F.col("invoice_id").isNotNull())
    out = (dated
           .join(track.select("track_id", "album_id", F.col("name").alias("song_title")), "track_id")
           .join(album.select("album_id", "artist_id", F.col("title").alias("album_title")), "album_id")
           .join(artist.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
           .withColumn("total_price", line_total("quantity", "unit_price"))
           .select("artist_id", "track_id", "invoice_line_id", "invoice_id", "artist_name", "album_title",
                   "song_title", "total_price", "invoice_date"))
    return conform(out, SALES_LINES)


def transactions(track: DataFrame, tables: LineTables) -> DataFrame:
    """Q3 on published tables whose invoice side is ``customer_invoices``."""
    out = (tables.joined().where(F.col("invoice_id").isNotNull())
           .join(track.select("track_id"), "track_id")
           .withColumnRenamed("customer_id_out", "customer_id")
           .select(*TRANSACTIONS.fieldNames()))
    return conform(out, TRANSACTIONS)


def publish_customer_invoices(invoice_line: DataFrame, invoice: DataFrame, customer: DataFrame,
                              last_name_repair: tuple[str, str] = datasets.LAST_NAME_REPAIR,
                              address_repair: tuple[str, str] = datasets.ADDRESS_REPAIR, **options) -> LineTables:
    """The tables of Q3: (invoice_id, track_id) lines, and invoices with their customer."""
    invoices = datasets.customer_invoices(invoice, customer, last_name_repair, address_repair)
    return publish_line_tables(invoice_line.select("invoice_id", "track_id"), invoices, **options)
