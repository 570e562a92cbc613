"""Refresh-on-arrival for the daily revenue mart (Structured Streaming).

The batch job re-reads everything on a clock.  Here new files in landing
folders are the trigger: whenever lines, or any other role whose folder is
watched, have arrived, the mart is computed by the batch plan from all that is
there now and replaced as a whole.  Nothing is carried from one trigger to the
next but which files have been seen, so an invoice or a track that arrives
after its lines corrects the mart, and the result always equals the batch
mart.

Cost per trigger: one batch refresh of the mart.  Choose the trigger interval
accordingly.

The list of files seen lives under a checkpoint location in the shared
checkpoint folder (``spark.checkpoint.dir``), so a restarted query resumes
where it stopped and a lost executor only repeats its tasks.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martwright.plans import marts
from martwright.session import checkpoint_dir
from martwright.sinks import publish

ROLES = ("artist", "album", "track", "invoice_line", "invoice")


def read_landing(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming reader over a landing folder; the schema is given, not inferred."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_daily_revenue(spark: SparkSession, role: Callable[[str], DataFrame],
                        landing: Mapping[str, tuple[str, StructType]],
                        target_path: str, checkpoint_location: str | None = None,
                        processing_time: str | None = None, available_now: bool = False,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the query; each trigger replaces ``target_path`` with the full mart.

    ``landing``: folder and schema of each role that arrives as files (lines
    at least); ``role`` opens the other roles and is called anew at each trigger.
    """
    if checkpoint_location is None:
        checkpoint_location = posixpath.join(checkpoint_dir(spark), "streams", "daily_revenue")
    arrivals = None
    for name, (path, schema) in landing.items():
        seen = read_landing(spark, path, schema, max_files_per_trigger=max_files_per_trigger).select(
            F.lit(name).alias("role"))
        arrivals = seen if arrivals is None else arrivals.union(seen)

    def now(name: str) -> DataFrame:
        if name in landing:
            path, schema = landing[name]
            return spark.read.schema(schema).parquet(path)
        return role(name)

    def replace(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            publish(marts.daily_revenue_from_sources(*map(now, ROLES)), path=target_path)

    writer = arrivals.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(replace)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
