"""Property test: list helpers agree with Python list methods.

Each hypothesis example is a *batch* of random lists (with repeats and
Nones), checked in one Spark job.
"""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright.functions import collections as L

small = st.one_of(st.none(), st.integers(0, 4))
case = st.tuples(st.lists(small, max_size=6), st.integers(-8, 8), small)


def _py(a, i, v):
    ins = list(a)
    ins.insert(i, 9)
    rm = list(a)
    if v in rm:
        rm.remove(v)
    st_ = list(a)
    if -len(a) <= i < len(a):
        st_[i] = 9
    return {
        "get": a[i] if -len(a) <= i < len(a) else None,
        "ins": ins, "set": st_, "rm": rm,
        "cnt": a.count(v), "idx": a.index(v) if v in a else None,
        "pop": a[:-1], "last": a[-1] if a else None,
        "app": a + [v], "ext": a + [v, v],
    }


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(case, min_size=1, max_size=40))
def test_list_helpers_match_python(spark, cases):
    df = spark.createDataFrame([(k, a, i, v) for k, (a, i, v) in enumerate(cases)],
                               "k int, a array<bigint>, i int, v bigint")
    nine = F.lit(9).cast("bigint")
    rows = df.select(
        "k",
        L.list_get("a", F.col("i")).alias("get"),
        L.list_insert("a", F.col("i"), nine).alias("ins"),
        L.list_set("a", F.col("i"), nine).alias("set"),
        L.list_remove_first("a", F.col("v")).alias("rm"),
        L.list_count("a", F.col("v")).alias("cnt"),
        L.list_index("a", F.col("v")).alias("idx"),
        L.list_pop("a").alias("pop"),
        L.list_last("a").alias("last"),
        L.list_append("a", F.col("v")).alias("app"),
        L.list_extend("a", F.array(F.col("v"), F.col("v"))).alias("ext")).collect()
    for r in rows:
        a, i, v = cases[r.k]
        want = _py(a, i, v)
        got = {key: r[key] for key in want}
        assert got == want, (a, i, v)
