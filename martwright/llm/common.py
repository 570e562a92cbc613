"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martwright.sinks.scratch import written

# Word separators of all contracts here: space and the control characters 9-13.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each context, so
    that their Python workers can import it wherever the job was started."""
    sc = spark.sparkContext
    if getattr(sc, "_martwright_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="martwright-"), "martwright_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._martwright_shipped = True


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back.

    It cuts the lineage: a lost executor costs no recomputation of what lies
    before, and the columnar files let later steps read only what they use.
    ``martwright.sinks.scratch.clean`` removes the session's tables.
    """
    return written(df, name)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names starting with ``names`` that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that an extra column can't clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all else as it is.

    ``lower`` does the same for pure ASCII and is much faster there.
    """
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, LOWER))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 (null: none).

    ``bytes.split`` splits at just these six bytes, unlike ``str.split``.
    """
    return text.encode("utf-8", "replace").split() if text else []


def workers(spark: SparkSession) -> int:
    """Shuffle width of the session, the number of tasks to aim at least for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, schema: str, fn) -> DataFrame:
    """``df`` through ``fn``, an Arrow batch in, a dict of columns out.

    Batches are bounded by Spark (rows and bytes), so memory does not grow
    with the table.
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            out = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c := out[f.name], pa.Array) else pa.array(c, type=f.type) for f in arrow],
                schema=arrow)

    return df.mapInArrow(run, schema)


def labelled_sample(documents: DataFrame, labels: DataFrame, label_col: str, bound: int,
                    skip_mod: tuple[int, int] | None = None) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled rows, those with
    the smallest hash of their id.  ``skip_mod=(m, r)`` leaves out the rows
    whose crc32(doc_id as text) mod m is r.  The bound keeps the broadcast of
    the ids small whatever the tables hold.  Of documents that share an id, the
    one with the least hash of its text stands for it.
    """
    label = F.col(f"`{label_col}`").cast("int")
    known = labels.where(F.col("doc_id").isNotNull() & label.isNotNull())
    if skip_mod:
        known = known.where(F.crc32(F.col("doc_id").cast("string")) % skip_mod[0] != skip_mod[1])
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    found = only(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    return found.groupBy("doc_id", "label").agg(least).select("doc_id", "least.text", "label")
