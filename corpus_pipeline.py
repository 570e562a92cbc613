"""Training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept, and is written as Parquet and read again before the next one.  All but
the last return the columns of ``documents``; the last gives one row for each
piece of a packed sequence.

Defined results, in every stage: extra columns stay as they are, whatever their
names, up to packing, which returns its own columns alone; repeated rows are
judged row by row, but for the SimHash stage, which keeps one of them; very
long texts are read whole; an empty table gives an empty table.  Nulls, empty
texts and ties are told stage by stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from martwright.llm import line_dedup, packing, pii, simhash, toxicity
from martwright.llm.queries import (CAPACITY, DISTANCE, END_ID, MIN_CHARS, MIN_DOCS, SHINGLE, TOXIC_FROM,
                                    toxicity_machine)
from martwright.session import checkpoint_dir


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  A null or empty text gets the
    score of a text without terms; a null id is scored like any other."""
    return toxicity.keep_clean(docs, toxicity_machine(spark, sf_dir), TOXIC_FROM)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go.  A null text is one empty line; an
    empty line's key is too short to count, so it stays; null ids count as one
    document."""
    return line_dedup.drop_common_lines(docs, MIN_DOCS, MIN_CHARS, counts=False)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest
    id (null ids last).  Texts without words are one group."""
    return simhash.keep_first(docs, SHINGLE, DISTANCE)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to its kind in brackets; a null text stays null,
    an empty one empty."""
    return pii.mask_pii(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as tokens in sequences: one row for each piece, with its place.  A
    null or empty text is the end id alone; a null id stays."""
    return packing.pack_documents(docs, capacity=CAPACITY, end_id=END_ID)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("simhash", simhash_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# Learned scores, fingerprints and tokens have no SQL form: tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared
    checkpoint folder, so a lost executor costs no earlier stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        path = f"{base}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
