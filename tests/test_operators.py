"""Table operators and list/map helpers against brute-force Python."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martwright import operators as O
from martwright.functions import collections as L
from martwright.functions import exprs as X


@pytest.fixture(scope="module")
def skewed_events(spark):
    """Key 0 holds over a third of all rows and spans many day chunks; some
    chunks of key 0 are empty, ties on ts are broken by the id."""
    rng = random.Random(7)
    rows, eid = [], 0
    base = dt.datetime(2024, 1, 1)
    for key in [*range(6), None]:  # None: the null key is one group too
        n = 400 if key == 0 else 60
        for _ in range(n):
            day = rng.choice([0, 1, 2, 5, 9]) if key == 0 else rng.randrange(4)
            ts = base + dt.timedelta(days=day, seconds=rng.randrange(0, 86400, 600))
            kind = rng.choice(["view", "click", "purchase"] if (key or 1) % 2 else ["view", "click"])
            rows.append((eid, key, ts, float(rng.randrange(100)), kind))
            eid += 1
    return spark.createDataFrame(
        rows, "event_id bigint, user_id bigint, ts timestamp_ntz, value double, event_type string")


def _by_key(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["user_id"] is None, r["user_id"] or 0, r["ts"],
                                         r["event_id"])):
        out.setdefault(r["user_id"], []).append(r)
    return out


def test_neighbour_diff_matches_brute_force(skewed_events):
    rows = [r.asDict() for r in skewed_events.collect()]
    expect = {}
    for seq in _by_key(rows).values():
        prev = None
        for r in seq:
            expect[r["event_id"]] = (prev, None if prev is None else r["value"] - prev)
            prev = r["value"]
    for unit in ("day", "hour", "month"):
        got = {r.event_id: (r.prev_value, r.diff)
               for r in O.neighbour_diff(skewed_events, "user_id", "ts", "event_id", "value",
                                         chunk_unit=unit).collect()}
        assert got == expect, unit


def test_take_until_matches_brute_force(skewed_events):
    rows = [r.asDict() for r in skewed_events.collect()]
    expect = set()
    for seq in _by_key(rows).values():
        for r in seq:
            expect.add(r["event_id"])
            if r["event_type"] == "purchase":
                break
    got = {r.event_id for r in O.take_until(skewed_events, "user_id", ["ts", "event_id"],
                                            F.col("event_type") == "purchase").collect()}
    assert got == expect


def test_take_until_plan_has_no_window(skewed_events):
    df = O.take_until(skewed_events, "user_id", ["ts", "event_id"],
                      F.col("event_type") == "purchase")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_threshold_and_share(spark):
    df = spark.createDataFrame([(1, 40.0, "a"), (1, 50.0, "b"), (1, 51.0, "a"), (2, 90.0, "a")],
                               "k bigint, v double, t string")
    got = {r.k: (r.n_at_or_below, r.n_above, r.max_at_or_below)
           for r in O.threshold_summary(df, "k", "v").collect()}
    assert got == {1: (2, 1, 50.0), 2: (0, 1, None)}
    share = {r.k: r.share for r in O.event_share(df, "k", F.col("t") == "a").collect()}
    assert share == {1: pytest.approx(2 / 3), 2: 1.0}
    assert O.record_count(df).first().n_records == 4


def test_append_rows_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, name string")
    b = spark.createDataFrame([("y", 2, True)], "name string, id bigint, flag boolean")
    got = sorted((r.id, r.name, r.flag) for r in O.append_rows(a, b).collect())
    assert got == [(1, "x", None), (2, "y", True)]


# --- list helpers vs Python list semantics ---------------------------------------

LISTS = [[], [7], [1, 2, 3], [5, 5, 1, 5], [3, 1, 2, 1]]


def _py_insert(a, i, v):
    b = list(a)
    b.insert(i, v)
    return b


def _py_remove(a, v):
    b = list(a)
    if v in b:
        b.remove(v)
    return b


def _py_set(a, i, v):
    b = list(a)
    if -len(b) <= i < len(b):
        b[i] = v
    return b


@pytest.fixture(scope="module")
def lists_df(spark):
    return spark.createDataFrame([(i, a) for i, a in enumerate(LISTS)], "id int, a array<bigint>")


@pytest.mark.parametrize("index", [-5, -1, 0, 1, 2, 3, 10])
def test_list_index_ops(lists_df, index):
    rows = lists_df.select(
        "id",
        L.list_get("a", index).alias("get"),
        L.list_insert("a", index, F.lit(99).cast("bigint")).alias("ins"),
        L.list_set("a", index, F.lit(42).cast("bigint")).alias("set")).collect()
    for r in rows:
        a = LISTS[r.id]
        expect_get = a[index] if -len(a) <= index < len(a) else None
        assert r.get == expect_get
        assert r.ins == _py_insert(a, index, 99)
        assert r.set == _py_set(a, index, 42)


@pytest.mark.parametrize("value", [1, 5, 8])
def test_list_value_ops(lists_df, value):
    v = F.lit(value).cast("bigint")
    rows = lists_df.select(
        "id",
        L.list_remove_first("a", v).alias("rm"),
        L.list_count("a", v).alias("cnt"),
        L.list_index("a", v).alias("idx"),
        L.list_pop("a").alias("pop"),
        L.list_last("a").alias("last"),
        L.list_sort("a").alias("srt"),
        L.list_clear("a").alias("clr"),
        L.list_append("a", v).alias("app"),
        L.list_extend("a", F.array(v, v)).alias("ext")).collect()
    for r in rows:
        a = LISTS[r.id]
        assert r.rm == _py_remove(a, value)
        assert r.cnt == a.count(value)
        assert r.idx == (a.index(value) if value in a else None)
        assert r.pop == a[:-1]
        assert r.last == (a[-1] if a else None)
        assert r.srt == sorted(a)
        assert r.clr == []
        assert r.app == a + [value]
        assert r.ext == a + [value, value]


def test_map_helpers(spark):
    df = spark.createDataFrame([({"a": 1, "b": 2},)], "m map<string,bigint>")
    r = df.select(
        L.map_get("m", F.lit("a")).alias("a"),
        L.map_get("m", F.lit("zz")).alias("missing"),
        L.map_set("m", F.lit("a"), F.lit(9).cast("bigint")).alias("set"),
        L.map_set("m", F.lit("c"), F.lit(3).cast("bigint")).alias("add"),
        L.map_remove("m", F.lit("b")).alias("rm")).first()
    assert r.a == 1 and r.missing is None
    assert r.set == {"a": 9, "b": 2}
    assert r.add == {"a": 1, "b": 2, "c": 3}
    assert r.rm == {"a": 1}
    with pytest.raises(Exception):
        df.select(L.map_get_strict("m", F.lit("zz"))).collect()


def test_zip_rows_pads_shorter(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [10, 20])],
                               "id int, names array<string>, nums array<int>")
    got = [(r.name, r.num) for r in
           L.zip_rows(df, ["id"], {"name": F.col("names"), "num": F.col("nums")}).collect()]
    assert got == [("a", 10), ("b", 20), ("c", None)]


# --- scalar rules ------------------------------------------------------------------

def test_grade_and_bands(spark):
    df = spark.createDataFrame([(s,) for s in [95.0, 90.0, 86.0, 85.0, 81.0, 76.0, 71.0, 70.0,
                                               None]], "s double")
    got = [r.g for r in df.select(X.grade("s").alias("g")).collect()]
    assert got == ["A", "AB", "AB", "B", "B", "BC", "C", "D", None]
    df2 = spark.createDataFrame([(r,) for r in [18.4, 18.5, 22.99, 23.0, 24.9, 25.0]], "r double")
    got2 = [r.b for r in df2.select(X.ratio_band("r").alias("b")).collect()]
    assert got2 == ["underweight", "normal", "normal", "overweight", "overweight", "obese"]


def test_money_rules(spark):
    df = spark.createDataFrame([(820.5, 3.5, 1234, 8)], "p double, t double, a bigint, n int")
    r = df.select(
        X.simple_interest("p", 0.0275, "t").alias("si"),
        X.simple_interest(F.lit(1e9), 0.0000004, F.lit(1)).alias("small"),
        F.round(X.compound_growth("p", F.lit(0.0275), F.lit(2)), 2).alias("cg"),
        X.equal_split("a", "n").alias("split"),
        X.equal_split(F.lit(-5), F.lit(2)).alias("negative_split"),
        X.goal_shortfall(F.lit(99.996), F.lit(100.0)).alias("short"),
        X.goal_shortfall(F.lit(100.0), F.lit(100.0)).alias("reached")).first()
    assert r.si == 899.47
    assert r.small == 1000000400.0
    assert r.cg == pytest.approx(866.25, abs=0.01)
    assert (r.split, r.negative_split) == (154, -2)
    assert (r.short, r.reached) == (0.004, 0.0)


def test_text_rules(spark):
    df = spark.createDataFrame([("admin",), ("eve",), (None,)], "n string")
    got = [r.m for r in df.select(
        X.templated_message("n", "Hi %s", "Welcome back %s", special_values=["admin"])
        .alias("m")).collect()]
    assert got == ["Welcome back admin", "Hi eve", None]
    r = spark.createDataFrame([("plum",)], "s string").select(
        X.char_at("s", 0).alias("c0"), X.char_at("s", 9).alias("c9"), X.char_at("s", -1).alias("last"),
        F.repeat("s", 2).alias("rep")).first()
    assert (r.c0, r.c9, r.last, r.rep) == ("p", "", "m", "plumplum")


def test_dictionary_rules_with_nulls(spark):
    from martwright.functions import collections as L

    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    none = F.lit(None).cast("string")
    r = spark.range(1).select(
        L.map_remove(m, none).alias("kept"), L.map_set(m, none, F.lit(9)).alias("unset"),
        L.map_update(m, F.create_map(F.lit("b"), F.lit(7), F.lit("c"), F.lit(8))).alias("updated"),
        L.map_fromkeys(F.array(F.lit("x"), none, F.lit("x")), F.lit(0)).alias("built"),
        L.map_clear(m).alias("cleared"),
        L.list_insert(F.array(F.lit(1)), F.lit(None).cast("int"), F.lit(2)).alias("no_index"),
        L.list_pop_at(F.array(F.lit(1), F.lit(2), F.lit(3)), -2).alias("popped"),
        L.list_pop_at(F.array(F.lit(1)), 5).alias("out_of_range")).first()
    assert r.kept == r.unset == {"a": 1, "b": 2}
    assert r.updated == {"a": 1, "b": 7, "c": 8}
    assert (r.built, r.cleared, r.no_index) == ({"x": 0}, {}, None)
    assert (r.popped, r.out_of_range) == ([1, 3], [1])


def test_zip_rows_keeps_the_other_list(spark):
    from martwright.functions import collections as L

    df = spark.createDataFrame([(1, ["a", "b"], None), (2, None, None)],
                               "id int, l array<string>, r array<int>")
    got = sorted((r.id, r.x, r.y) for r in L.zip_rows(df, ["id"], {"x": F.col("l"), "y": F.col("r")}).collect())
    assert got == [(1, "a", None), (1, "b", None)]
