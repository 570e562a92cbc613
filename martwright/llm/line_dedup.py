"""Operator 10, line dedup: drop lines that many documents share.

Method: explode normalised lines, hash, count distinct documents per hash,
drop the lines over the threshold, reassemble by position.  DataFrame
functions only.

The hashed lines are written once, as ``id, version, position, hash``; counting
and finding read that table, not the texts.  Hashes with more than one in
``HEAVY`` of all lines, fewer than ``HEAVY`` whatever the table holds, are found
by a broadcast of them, so a very common line is never dealt to one task; all
others meet the rest of the lines in a join by hash.

Defined results: a null or empty text is one empty line; a line whose key is
shorter than ``min_chars`` always stays; rows that repeat a document id count
as one document and each keeps its own row; a null id counts as one document;
an empty table gives an empty table; output columns replace input columns of
the same name, all other columns stay, whatever their names; a very long text is
one row throughout, and its line positions are gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.common import SPACES, ascii_lower, fresh, stored

HEAVY = 65_536  # hashes are heavy above this part of all lines, so fewer than this many are


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _hash(key: Column) -> Column:
    """16 bytes of SHA-256: two different lines never meet in practice."""
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                      id_col: str = "doc_id", text_col: str = "text", counts: bool = True) -> DataFrame:
    """``docs`` with the shared lines cut from ``text_col``, and ``n_lines``
    (before) and ``n_dropped``; without ``counts`` the columns of ``docs`` alone.

    Shuffles: the line hashes to be counted (pre-aggregated, (hash, document)
    pairs first, so a line in a third of all documents is no hot task), those
    that aren't heavy once more to meet the common ones, and the documents once,
    against their dropped positions.
    """
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    version, drop, lines, d_id, d_version = fresh(docs, "_version", "_drop", "_lines", "_d_id", "_d_version")
    # a document row is found again by its id and a hash of its text
    keyed = docs.withColumn(version, F.xxhash64(text))
    hashed = stored(
        keyed.select(doc.alias("id"), F.col(version).alias("v"), F.posexplode(_lines(text)))
        .select("id", "v", "pos", line_key(F.col("col")).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("id", "v", "pos", _hash(F.col("key")).alias("hash")), "lines")
    common = stored(
        hashed.groupBy("hash", "id").agg(F.count("pos").alias("rows"))
        .groupBy("hash").agg(F.count("rows").alias("n"), F.sum("rows").alias("rows"))
        .where(F.col("n") >= min_docs).select("hash", "rows"), "common")
    heavy = F.col("rows") * HEAVY > hashed.count()
    often, seldom = common.where(heavy).select("hash"), common.where(~heavy).select("hash")
    found = (hashed.join(F.broadcast(often), "hash", "left_semi")
             .union(hashed.join(F.broadcast(often), "hash", "left_anti").join(seldom, "hash", "left_semi")))
    dropped = (found.groupBy("id", "v").agg(F.sort_array(F.collect_set("pos")).alias("drop"))
               .select(F.col("id").alias(d_id), F.col("v").alias(d_version), F.col("drop").alias(drop)))
    joined = (keyed.join(dropped, doc.eqNullSafe(F.col(d_id)) & (F.col(version) == F.col(d_version)), "left")
              .drop(d_id, d_version).withColumn(lines, _lines(text)))
    n, cut = F.size(lines), F.col(drop)

    def between(i: Column) -> Column:
        """The lines between the dropped ones i - 1 and i."""
        last = F.when(i == 0, F.lit(-1)).otherwise(F.get(cut, i - 1))
        nxt = F.coalesce(F.get(cut, i), n)
        return F.slice(lines, last + 2, nxt - last - 1)

    kept = F.when(cut.isNull(), F.col(lines)).otherwise(
        F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut)), between)))
    if counts:
        joined = (joined.withColumn("n_lines", n.cast("long"))
                  .withColumn("n_dropped", F.when(cut.isNull(), F.lit(0)).otherwise(F.size(cut)).cast("long")))
    return joined.withColumn(text_col, F.concat_ws("\n", kept)).drop(version, drop, lines)
