from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def small(spark):
    """The small documents as a list of (doc_id, text)."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def messy(spark):
    """Null, empty, blank, very long and repeated texts, null and repeated
    ids, nulls in the other columns, and columns whose names clash with what
    operators use inside."""
    passage = " ".join(f"word{i % 97}x{i % 89}" for i in range(400))
    long = " ".join(f"w{i * 7919 % 1009}" for i in range(60_000)) + "\n" + "a@b.co " * 500
    texts = [None, "", " \t\n ", "One two", "Mixed CASE é Ünï ßtraße 🤗 text\nsame line\n same LINE \n", passage,
             passage + " tail", "head " + passage, long, "4111 1111 1111 1111 +1 (784) 555-9263 1.2.3.4 x@y.z",
             "a" * 30_000, "1" * 30_000, "1 " * 5_000, "x\n" * 3_000]
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", "s", 1), (None, None, None, None, None), (5, passage, "en", "s", 1),
             (3, "Two one", "de", "s", 1), (99, "One two", "en", "s", 1), (98, passage, "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "fp", "key", "hash", "block", "v", "_version", "_drop", "_lines", "N_Lines", "PII", "score",
                 "slice", "label", "_key", "held", "_text", "words", "component_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)


