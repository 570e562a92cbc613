"""Registered queries on mixed lists, free records and row-giving SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import sql_functions
from martwright.functions import variants as V
from martwright.registry._inputs import table as read_table


def _mixed_lists(spark, d):
    """A list of a number, two texts, a fraction, a truth value and a null for
    each document, read back by index and type."""
    doc = read_table(spark, d, "documents")
    half = F.col("n_chars") / F.lit(2)
    long = F.col("n_chars") > F.lit(1000)
    made = doc.select("doc_id", V.mixed_list("doc_id", "lang", "source", half, long, F.lit(None).cast("string")).alias("xs"))
    return made.select(
        "doc_id", F.size("xs").alias("n"),
        V.mixed_get("xs", 0, "bigint").alias("number"), V.mixed_get("xs", 1, "string").alias("lang"),
        V.mixed_get("xs", 2, "bigint").alias("no_number"), V.mixed_get("xs", -3, "double").alias("half"),
        V.mixed_get("xs", 4, "boolean").alias("is_long"), V.mixed_get("xs", 5, "string").alias("nothing"),
        V.mixed_get("xs", 6, "string").alias("past_end"), V.mixed_type("xs", 3).alias("half_type"))


def _free_fields(spark, d):
    """Documents and orders appended as free records."""
    doc = read_table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    order = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return V.append_records(doc, order).select(
        V.field("record", "doc_id", "bigint").alias("doc_id"), V.field("record", "lang", "string").alias("lang"),
        V.field("record", "n_chars", "int").alias("n_chars"),
        V.field("record", "o_orderkey", "bigint").alias("o_orderkey"),
        V.field("record", "o_totalprice", "double").alias("o_totalprice"),
        V.field("record", "o_orderstatus", "string").alias("o_orderstatus"),
        V.field("record", "unknown", "string").alias("unknown"))


def _lateral_words(spark, d):
    """Each word of each text as a row, by a SQL table function."""
    sql_functions.register_table_functions(spark)
    return spark.sql("SELECT t.doc_id, w.pos, md5(w.word) AS word FROM {t} t, LATERAL word_rows(t.text) w",
                     t=read_table(spark, d, "documents"))


def _lateral_pairs(spark, d):
    """The entries of a map as rows, by a SQL table function."""
    sql_functions.register_table_functions(spark)
    return spark.sql("SELECT t.o_orderkey, p.name, p.item FROM {t} t, "
                     "LATERAL pair_rows(map('status', t.o_orderstatus, 'priority', t.o_orderpriority)) p",
                     t=read_table(spark, d, "orders"))


def _lateral_zip(spark, d):
    """Parallel lists as rows, by a SQL table function."""
    sql_functions.register_table_functions(spark)
    return spark.sql("SELECT t.p_partkey, z.first, z.second FROM {t} t, "
                     "LATERAL zipped_rows(split(t.p_name, ' '), array(t.p_brand, t.p_type)) z",
                     t=read_table(spark, d, "part"))


QUERIES = {
    "mixed_lists": _mixed_lists,
    "free_fields": _free_fields,
    "lateral_words": _lateral_words,
    "lateral_pairs": _lateral_pairs,
    "lateral_zip": _lateral_zip,
}

ORACLE = {
    "mixed_lists": """
SELECT doc_id, 6 AS n, doc_id AS number, lang, TRY_CAST(source AS BIGINT) AS no_number,
       n_chars / CAST(2 AS DOUBLE) AS half, n_chars > 1000 AS is_long, CAST(NULL AS VARCHAR) AS nothing,
       CAST(NULL AS VARCHAR) AS past_end, CASE WHEN n_chars IS NOT NULL THEN 'DOUBLE' END AS half_type
FROM documents
""",
    "free_fields": """
SELECT doc_id, lang, n_chars, CAST(NULL AS BIGINT) AS o_orderkey, CAST(NULL AS DOUBLE) AS o_totalprice,
       CAST(NULL AS VARCHAR) AS o_orderstatus, CAST(NULL AS VARCHAR) AS unknown FROM documents
UNION ALL
SELECT NULL, NULL, NULL, o_orderkey, o_totalprice, o_orderstatus, NULL FROM orders
""",
    "lateral_words": """
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, md5(word) AS word
FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
      FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))
""",
    "lateral_pairs": """
SELECT o_orderkey, 'status' AS name, o_orderstatus AS item FROM orders
UNION ALL
SELECT o_orderkey, 'priority', o_orderpriority FROM orders
""",
    "lateral_zip": """
SELECT p_partkey, unnest(words) AS first, unnest(codes) AS second
FROM (SELECT p_partkey, string_split(p_name, ' ') AS words, [p_brand, p_type] AS codes FROM part)
""",
}
