"""R4 and R5 keep the digits of any amount; list queries keep whole texts."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from martwright import registry
from martwright.functions import exprs as X


def _one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_large_principal_small_rate_long_periods(spark):
    assert _one(spark, X.simple_interest(F.lit(1e15), 0.05, F.lit(2))) == 1.1e15
    assert _one(spark, X.simple_interest(F.lit(1e15), 4e-13, F.lit(1))) == 1e15 + 400
    assert _one(spark, X.simple_interest(F.lit(1e9), 4e-13, F.lit(1e6))) == 1e9 + 400
    assert _one(spark, X.simple_interest(F.lit(1e9), 0.01, F.lit(0.1234567))) == pytest.approx(1e9 + 1234567.0, abs=0.005)
    assert _one(spark, X.simple_interest(F.lit(100.12345), 0.5, F.lit(1), 6)) == pytest.approx(150.185175, abs=1e-9)
    assert _one(spark, X.simple_interest(F.lit(1e300), 0.5, F.lit(2))) == 2e300
    # decimal arithmetic where it is exact: a half cent goes up
    assert _one(spark, X.simple_interest(F.lit(0.5), 0.01, F.lit(1))) == 0.51
    assert _one(spark, X.simple_interest(F.lit(None).cast("double"), 0.01, F.lit(1))) is None


def test_shortfall_of_any_size(spark):
    assert _one(spark, X.goal_shortfall(F.lit(1e25), F.lit(3e25))) == 3e25 - 1e25
    assert _one(spark, X.goal_shortfall(F.lit(0.1), F.lit(0.3))) == 0.2
    assert _one(spark, X.goal_shortfall(F.lit(1e-20), F.lit(3e-20))) == pytest.approx(2e-20)
    assert _one(spark, X.goal_shortfall(F.lit(5.0), F.lit(5.0))) == 0.0
    assert _one(spark, X.goal_shortfall(F.lit(None).cast("double"), F.lit(5.0))) is None


@pytest.mark.parametrize("name", ["array_append_extend", "array_insert", "array_replace_remove", "array_misc"])
def test_list_queries_keep_every_word(spark, name):
    want = dict(duckdb.sql(f"SELECT doc_id, len(string_split(text, ' ')) FROM '{SF_SMALL}/documents.parquet'").fetchall())
    got = {r.doc_id: r.n_words for r in registry.queries()[name](spark, SF_SMALL).select("doc_id", "n_words").collect()}
    assert got == want and sum(want.values()) > 10_000


def _line(lists, odd):
    """The columns of a line by Python's lists, for _lines queries."""
    o, p, s, n = lists
    show = lambda a: ",".join("null" if v is None else str(v) for v in a)

    def removed(a, v):
        a = list(a)
        if v in a:
            a.remove(v)
        return show(a)

    a = [n, s, n, o]
    return {
        "array_append_extend_lines": (show([p, s, n] + [o]), show([p, s, n] + [o, s]), 2),
        "array_insert_lines": (show([o, p, s, n]), show([p, o, s, n]), show([p, s, n, o]), show([p, s, o, n])),
        "array_replace_remove_lines": (show([p, 0, n]), show([p, s, o]), removed([n, s, n], n), removed([n, s, n], odd)),
        "array_misc_lines": (a.count(n), a.index(s), a.index(odd) if odd in a else None, show(a[:-1]), a[-1],
                             show(sorted(a, key=lambda v: (v is None, v))), 0, show(a[::-1])),
    }


@pytest.mark.parametrize("name", ["array_append_extend_lines", "array_insert_lines", "array_replace_remove_lines",
                                  "array_misc_lines"])
def test_list_queries_of_every_line(spark, tmp_path, name):
    """The lists of every line are made again, whatever their keys."""
    lines = [(1, 10, 20, 1), (1, 10, 20, 1), (2, 11, 3, 3), (4, 12, -1, 4), (5, None, 21, 2),
             (None, 13, 22, 1), (6, 14, None, 2), (7, 15, 23, None), (None, None, None, None), (-1, 1, 2, 3)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").repartition(3) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    got = sorted((tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((o, n, *_line((o, p, s, n), -1)[name]) for o, p, s, n in lines), key=repr)
    rel = f"read_parquet('{tmp_path}/lineitem.parquet/*.parquet')"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM {rel}")
    assert sorted(con.sql(registry.oracle_sql()[name]).fetchall(), key=repr) == got
    assert registry.queries()[name](spark, SF_SMALL).count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def _words(lang, text, doc_id):
    """The columns of a document by Python's lists, for the queries of words."""
    show = lambda a: None if a is None else ",".join("null" if v is None else v for v in a)
    a = None if text is None else [None if w == "de" else w for w in text.split(" ")]

    def by(change, *args):
        if a is None:
            return None
        b = list(a)
        change(b, *args)
        return show(b)

    def put(b, i, v):
        if i < len(b):
            b[i] = v

    def drop(b, v):
        if v in b:
            b.remove(v)

    n, even = a and len(a), doc_id is not None and doc_id % 2 == 0
    return {
        "array_append_extend": (n, by(list.append, lang), by(list.extend, [lang, "x"]), 2),
        "array_insert": (n, by(list.insert, 0, lang), by(list.insert, 1, lang), by(list.append, lang),
                         by(list.insert, -1, lang), by(list.insert, 0, lang) if even else None),
        "array_replace_remove": (n, by(put, 1, "X"), by(put, -1, lang), by(drop, "la"), by(drop, None), show(a)),
        "array_misc": (n, a and a.count("la"), a and a.count(None), a.index("la") if a and "la" in a else None, None,
                       by(list.pop), by(lambda b: b[1:2] and b.pop(1)), a[1] if a and n > 1 else None, a and a[-1],
                       a and show(sorted(a, key=lambda v: (v is None, v))), a and 0, by(list.reverse)),
    }


@pytest.mark.parametrize("name", ["array_append_extend", "array_insert", "array_replace_remove", "array_misc"])
def test_list_queries_show_the_lists(spark, tmp_path, name):
    """The lists themselves are in the rows, not digests of them."""
    docs = [(0, "en", "b de a la de la"), (1, "de", ""), (2, None, "la"), (3, "fr", None), (4, "en", "one  two"),
            (5, "en", "z la x"), (5, "en", "z la x"), (None, "en", "a b"), (6, "en", "de"), (7, "en", "b, a")]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3) \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in registry.queries()[name](spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((d, *_words(lang, text, d)[name]) for d, lang, text in docs), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(registry.oracle_sql()[name]).fetchall(), key=repr) == got
