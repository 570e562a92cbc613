"""Registered list and dictionary queries.

The lists are built per row from the row's own columns (words of a name, a
row's keys), so their size is bounded by the row, never by a group.  List
results are shown as text (``render_list``) so both engines print them the
same way; map results are compared as exploded rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import collections as L
from martwright.registry._inputs import table as read_table

# Order status code -> label, the lookup table of R19.
STATUS_LABELS = {"F": "fulfilled", "O": "open", "P": "partial"}
# Parameters of the list queries: the word that stands for null, one to find, and
# one that no list has.
NULL_WORD, FOUND_WORD, MISSING_WORD = "de", "la", " "


def _words(spark, d):
    p = read_table(spark, d, "part")
    return p.select("p_partkey", "p_brand", "p_type", F.split("p_name", " ").alias("words"))


def _doc_words(spark, d):
    """Lists of any length: all words of every whole text, some words null (a
    null text gives a null list)."""
    doc = read_table(spark, d, "documents")
    words = F.transform(F.split("text", " "), lambda w: F.nullif(w, F.lit(NULL_WORD)))
    return doc.select("doc_id", "lang", words.alias("words"))


def _line_keys(spark, d):
    """Short lists of numbers: the keys of every line."""
    li = read_table(spark, d, "lineitem")
    number = F.col("l_linenumber").cast("bigint")
    return li.select(
        "l_orderkey", "l_linenumber", "l_suppkey", number.alias("number"),
        F.array("l_partkey", "l_suppkey", number).alias("keys"),
        F.array(number, "l_suppkey", number).alias("twice"))


def _order_map(spark, d):
    o = read_table(spark, d, "orders")
    m = F.create_map(F.lit("status"), F.col("o_orderstatus"),
                     F.lit("priority"), F.col("o_orderpriority"))
    return o.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                    m.alias("m"))


def _array_access(spark, d):
    w = _words(spark, d)
    nested = F.array(F.col("words"), F.reverse("words"))
    return w.select(
        "p_partkey",
        L.list_get("words", 0).alias("first_word"),
        L.list_get("words", 1).alias("second_word"),
        L.list_get("words", 2).alias("third_word"),
        L.list_get("words", -1).alias("last_word"),
        L.list_len("words").alias("n_words"),
        L.list_get(L.list_get(nested, 1), 0).alias("nested_pick"))


def _array_append_extend(spark, d):
    w = _doc_words(spark, d)
    return w.select(
        "doc_id",
        L.list_len("words").alias("n_words"),
        L.render_list(L.list_append("words", F.col("lang"))).alias("appended"),
        L.render_list(L.list_extend("words", F.array("lang", F.lit("x")))).alias("extended"),
        L.list_len(L.list_append(F.array("words"), F.col("words"))).alias("nested_len"))


def _array_insert(spark, d):
    w, x = _doc_words(spark, d), F.col("lang")
    return w.select(
        "doc_id",
        L.list_len("words").alias("n_words"),
        L.render_list(L.list_insert("words", 0, x)).alias("at_start"),
        L.render_list(L.list_insert("words", 1, x)).alias("at_one"),
        L.render_list(L.list_insert("words", 1_000_000, x)).alias("past_end"),
        L.render_list(L.list_insert("words", -1, x)).alias("before_last"),
        L.render_list(L.list_insert("words", F.when(F.col("doc_id") % 2 == 0, 0), x)).alias("null_index"))


def _array_replace_remove(spark, d):
    w = _doc_words(spark, d)
    return w.select(
        "doc_id",
        L.list_len("words").alias("n_words"),
        L.render_list(L.list_set("words", 1, F.lit("X"))).alias("replaced"),
        L.render_list(L.list_set("words", -1, F.col("lang"))).alias("replaced_last"),
        L.render_list(L.list_remove_first("words", F.lit(FOUND_WORD))).alias("removed_first"),
        L.render_list(L.list_remove_first("words", F.lit(None).cast("string"))).alias("removed_null"),
        L.render_list(L.list_remove_first("words", F.lit("!"))).alias("removed_none"))


def _array_misc(spark, d):
    w, x = _doc_words(spark, d), F.lit(FOUND_WORD)
    return w.select(
        "doc_id",
        L.list_len("words").alias("n_words"),
        L.list_count("words", x).alias("count_word"),
        L.list_count("words", F.lit(None).cast("string")).alias("count_null"),
        L.list_index("words", x).alias("index_word"),
        L.list_index("words", F.lit(MISSING_WORD)).alias("index_missing"),
        L.render_list(L.list_pop("words")).alias("popped"),
        L.render_list(L.list_pop_at("words", 1)).alias("popped_at"),
        L.list_get("words", 1).alias("pop_at_value"),
        L.list_last("words").alias("pop_value"),
        L.render_list(L.list_sort("words")).alias("sorted"),
        L.list_len(L.list_clear("words")).alias("cleared_len"),
        L.render_list(F.reverse("words")).alias("reversed"))


def _array_append_extend_lines(spark, d):
    k = _line_keys(spark, d)
    return k.select(
        "l_orderkey", "l_linenumber",
        L.render_list(L.list_append("keys", F.col("l_orderkey"))).alias("appended"),
        L.render_list(L.list_extend("keys", F.array("l_orderkey", "l_suppkey"))).alias("extended"),
        L.list_len(L.list_append(F.array("keys"), F.col("keys"))).alias("nested_len"))


def _array_insert_lines(spark, d):
    k, x = _line_keys(spark, d), F.col("l_orderkey")
    return k.select(
        "l_orderkey", "l_linenumber",
        L.render_list(L.list_insert("keys", 0, x)).alias("at_start"),
        L.render_list(L.list_insert("keys", 1, x)).alias("at_one"),
        L.render_list(L.list_insert("keys", 10, x)).alias("past_end"),
        L.render_list(L.list_insert("keys", -1, x)).alias("before_last"))


def _array_replace_remove_lines(spark, d):
    k = _line_keys(spark, d)
    return k.select(
        "l_orderkey", "l_linenumber",
        L.render_list(L.list_set("keys", 1, F.lit(0).cast("bigint"))).alias("replaced"),
        L.render_list(L.list_set("keys", -1, F.col("l_orderkey"))).alias("replaced_last"),
        L.render_list(L.list_remove_first("twice", F.col("number"))).alias("removed_first"),
        L.render_list(L.list_remove_first("twice", F.lit(-1).cast("bigint"))).alias("removed_none"))


def _array_misc_lines(spark, d):
    k, a = _line_keys(spark, d), L.list_append("twice", F.col("l_orderkey"))
    return k.select(
        "l_orderkey", "l_linenumber",
        L.list_count(a, F.col("number")).alias("count_line"),
        L.list_index(a, F.col("l_suppkey")).alias("index_supp"),
        L.list_index(a, F.lit(-1).cast("bigint")).alias("index_missing"),
        L.render_list(L.list_pop(a)).alias("popped"),
        L.list_last(a).alias("pop_value"),
        L.render_list(L.list_sort(a)).alias("sorted"),
        L.list_len(L.list_clear(a)).alias("cleared_len"),
        L.render_list(F.reverse(a)).alias("reversed"))


def _map_lookup(spark, d):
    o = _order_map(spark, d)
    rec = F.struct(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return o.select(
        "o_orderkey",
        L.map_get("m", F.lit("status")).alias("status"),
        L.map_get("m", F.lit("clerk")).alias("missing"),
        L.map_get_strict("m", F.lit("priority")).alias("priority"),
        L.map_get(L.literal_map(STATUS_LABELS), F.col("o_orderstatus")).alias("status_label"),
        rec.getField("price").alias("record_price"))


def _map_set_remove(spark, d):
    o = _order_map(spark, d)
    changed = o.select("o_orderkey",
                       L.map_set("m", F.lit("status"), F.lit("X")).alias("set_m"),
                       L.map_remove("m", F.lit("priority")).alias("removed_m"))
    set_rows = L.map_rows(changed.withColumn("variant", F.lit("set")),
                          ["o_orderkey", "variant"], "set_m")
    removed_rows = L.map_rows(changed.withColumn("variant", F.lit("removed")),
                              ["o_orderkey", "variant"], "removed_m")
    return set_rows.unionByName(removed_rows)


def _map_explode(spark, d):
    return L.map_rows(_order_map(spark, d), ["o_orderkey"], "m")


def _map_misc(spark, d):
    o = _order_map(spark, d)
    other = F.create_map(F.lit("priority"), F.lit("P"), F.lit("extra"), F.col("o_orderstatus"))
    parts = L.map_fromkeys(F.split("o_orderpriority", "-"), F.lit(1))
    updated = L.map_update("m", other)
    return o.select(
        "o_orderkey",
        L.render_list(F.array_sort(F.map_keys("m"))).alias("keys"),
        L.render_list(F.array_sort(F.map_values("m"))).alias("vals"),
        F.size("m").alias("n_entries"),
        F.map_contains_key("m", "status").alias("has_status"),
        L.render_list(F.array_sort(F.map_keys(updated))).alias("updated_keys"),
        L.map_get(updated, F.lit("priority")).alias("updated_priority"),
        L.map_get(updated, F.lit("extra")).alias("updated_extra"),
        L.render_list(F.array_sort(F.map_keys(parts))).alias("built_keys"),
        L.list_len(F.map_keys(L.map_clear("m"))).alias("n_cleared"))


def _zip_rows(spark, d):
    w = _words(spark, d)
    return L.zip_rows(w, ["p_partkey"],
                      {"word": F.col("words"), "code": F.array("p_brand", "p_type")})


QUERIES = {
    "array_access": _array_access,
    "array_append_extend": _array_append_extend,
    "array_insert": _array_insert,
    "array_replace_remove": _array_replace_remove,
    "array_misc": _array_misc,
    "array_append_extend_lines": _array_append_extend_lines,
    "array_insert_lines": _array_insert_lines,
    "array_replace_remove_lines": _array_replace_remove_lines,
    "array_misc_lines": _array_misc_lines,
    "map_lookup": _map_lookup,
    "map_set_remove": _map_set_remove,
    "map_explode": _map_explode,
    "map_misc": _map_misc,
    "zip_rows": _zip_rows,
}


def _r(expr: str) -> str:
    """DuckDB text form of a list, nulls shown (same as render_list)."""
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE "
            f"coalesce(array_to_string([coalesce(w, 'null') FOR w IN {expr}], ','), '') END")


def _n(expr: str) -> str:
    return _r(f"CAST({expr} AS VARCHAR[])")


def _of_words(columns: str) -> str:
    return f"""
SELECT doc_id, CAST(n AS INTEGER) AS n_words, {columns}
FROM (SELECT doc_id, lang, words AS l, CAST(len(words) AS BIGINT) AS n,
             list_position(words, '{FOUND_WORD}') AS p,
             list_position([w IS NULL FOR w IN words], true) AS q
      FROM (SELECT doc_id, lang, [nullif(w, '{NULL_WORD}') FOR w IN string_split(text, ' ')] AS words
            FROM documents))
"""


def _if_list(expr: str) -> str:
    return f"(CASE WHEN l IS NULL THEN NULL ELSE {expr} END)"


def _without(at: str) -> str:
    return f"(CASE WHEN coalesce({at}, 0) = 0 THEN l ELSE l[1:{at} - 1] || l[{at} + 1:] END)"


def _of_lines(columns: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, {columns}
FROM (SELECT *, l_orderkey AS o, l_partkey AS p, l_suppkey AS s, CAST(l_linenumber AS BIGINT) AS n FROM lineitem)
"""


_NULL_AT_ODD = "(CASE WHEN doc_id % 2 = 0 AND l IS NOT NULL THEN [lang] || l END)"

ORACLE = {
    "array_access": """
SELECT p_partkey, words[1] AS first_word, words[2] AS second_word, words[3] AS third_word,
       words[-1] AS last_word, CAST(len(words) AS INTEGER) AS n_words,
       list_reverse(words)[1] AS nested_pick
FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part)
""",
    "array_append_extend": _of_words(f"""
       {_r(_if_list("l || [lang]"))} AS appended,
       {_r(_if_list("l || [lang, 'x']"))} AS extended,
       2 AS nested_len"""),
    "array_insert": _of_words(f"""
       {_r(_if_list("[lang] || l"))} AS at_start,
       {_r(_if_list("l[1:1] || [lang] || l[2:]"))} AS at_one,
       {_r(_if_list("l || [lang]"))} AS past_end,
       {_r(_if_list("CASE WHEN n = 0 THEN [lang] ELSE l[1:n - 1] || [lang] || l[n:n] END"))} AS before_last,
       {_r(_NULL_AT_ODD)} AS null_index"""),
    "array_replace_remove": _of_words(f"""
       {_r("(CASE WHEN n > 1 THEN l[1:1] || ['X'] || l[3:] ELSE l END)")} AS replaced,
       {_r("(CASE WHEN n > 0 THEN l[1:n - 1] || [lang] ELSE l END)")} AS replaced_last,
       {_r(_without("p"))} AS removed_first,
       {_r(_without("q"))} AS removed_null,
       {_r("l")} AS removed_none"""),
    "array_misc": _of_words(f"""
       CAST(len(list_filter(l, lambda w: w = '{FOUND_WORD}')) AS INTEGER) AS count_word,
       CAST(len(list_filter(l, lambda w: w IS NULL)) AS INTEGER) AS count_null,
       CAST(CASE WHEN p > 0 THEN p - 1 END AS INTEGER) AS index_word,
       CAST(nullif(list_position(l, '{MISSING_WORD}'), 0) - 1 AS INTEGER) AS index_missing,
       {_r("(CASE WHEN n > 0 THEN l[1:n - 1] ELSE l END)")} AS popped,
       {_r("(CASE WHEN n > 1 THEN l[1:1] || l[3:] ELSE l END)")} AS popped_at,
       l[2] AS pop_at_value,
       CASE WHEN n > 0 THEN l[n] END AS pop_value,
       {_r("list_sort(l, 'ASC', 'NULLS LAST')")} AS sorted,
       CASE WHEN l IS NULL THEN NULL ELSE 0 END AS cleared_len,
       {_r("list_reverse(l)")} AS reversed"""),
    "array_append_extend_lines": _of_lines(f"""
       {_n("[p, s, n, o]")} AS appended,
       {_n("[p, s, n, o, s]")} AS extended,
       2 AS nested_len"""),
    "array_insert_lines": _of_lines(f"""
       {_n("[o, p, s, n]")} AS at_start,
       {_n("[p, o, s, n]")} AS at_one,
       {_n("[p, s, n, o]")} AS past_end,
       {_n("[p, s, o, n]")} AS before_last"""),
    "array_replace_remove_lines": _of_lines(f"""
       {_n("[p, CAST(0 AS BIGINT), n]")} AS replaced,
       {_n("[p, s, o]")} AS replaced_last,
       {_n("[s, n]")} AS removed_first,
       {_n("(CASE WHEN n = -1 THEN [s, n] WHEN s = -1 THEN [n, n] ELSE [n, s, n] END)")} AS removed_none"""),
    "array_misc_lines": _of_lines(f"""
       CAST(2 + CASE WHEN s IS NOT DISTINCT FROM n THEN 1 ELSE 0 END
              + CASE WHEN o IS NOT DISTINCT FROM n THEN 1 ELSE 0 END AS INTEGER) AS count_line,
       CAST(CASE WHEN s IS NOT DISTINCT FROM n THEN 0 ELSE 1 END AS INTEGER) AS index_supp,
       CAST(CASE WHEN n = -1 THEN 0 WHEN s = -1 THEN 1 WHEN o = -1 THEN 3 END AS INTEGER) AS index_missing,
       {_n("[n, s, n]")} AS popped,
       o AS pop_value,
       {_n("list_sort([n, s, n, o], 'ASC', 'NULLS LAST')")} AS sorted,
       0 AS cleared_len,
       {_n("[o, n, s, n]")} AS reversed"""),
    "map_lookup": """
SELECT o_orderkey, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS missing,
       o_orderpriority AS priority,
       CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open'
                          WHEN 'P' THEN 'partial' END AS status_label,
       o_totalprice AS record_price
FROM orders
""",
    "map_set_remove": """
SELECT o_orderkey, 'set' AS variant, 'priority' AS key, o_orderpriority AS value FROM orders
UNION ALL
SELECT o_orderkey, 'set' AS variant, 'status' AS key, 'X' AS value FROM orders
UNION ALL
SELECT o_orderkey, 'removed' AS variant, 'status' AS key, o_orderstatus AS value FROM orders
""",
    "map_explode": """
SELECT o_orderkey, 'status' AS key, o_orderstatus AS value FROM orders
UNION ALL
SELECT o_orderkey, 'priority' AS key, o_orderpriority AS value FROM orders
""",
    "map_misc": f"""
SELECT o_orderkey, 'priority,status' AS keys,
       {_r("list_sort([o_orderstatus, o_orderpriority], 'ASC', 'NULLS LAST')")} AS vals,
       2 AS n_entries, TRUE AS has_status, 'extra,priority,status' AS updated_keys,
       'P' AS updated_priority, o_orderstatus AS updated_extra,
       {_r("list_sort(list_distinct(string_split(o_orderpriority, '-')))")} AS built_keys,
       0 AS n_cleared
FROM orders
""",
    "zip_rows": """
SELECT p_partkey, unnest(words) AS word, unnest(codes) AS code
FROM (SELECT p_partkey, string_split(p_name, ' ') AS words, [p_brand, p_type] AS codes
      FROM part)
""",
}
