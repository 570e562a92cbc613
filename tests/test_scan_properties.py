"""Property test: neighbour_diff and take_until equal a plain per-key scan,
on random events with timestamp ties, null values and a null key."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martwright import operators as O

BASE = dt.datetime(2024, 1, 1)
event = st.tuples(
    st.one_of(st.none(), st.integers(0, 3)),          # key, sometimes null
    st.integers(0, 60 * 24 * 3),                      # minute offset (ties happen)
    st.one_of(st.none(), st.integers(-5, 5)),         # value, sometimes null
    st.booleans())                                    # stop event?


def _scan(rows):
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)
    prev, keep = {}, set()
    for seq in by_key.values():
        last = None
        stopped = False
        for eid, _k, _ts, v, stop in seq:
            prev[eid] = (last, None if last is None or v is None else v - last)
            last = v
            if not stopped:
                keep.add(eid)
                stopped = stop
    return prev, keep


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=80), st.sampled_from(["hour", "day", "month"]))
def test_scans_match_brute_force(spark, events, unit):
    rows = [(i, k, BASE + dt.timedelta(minutes=m), None if v is None else float(v), s)
            for i, (k, m, v, s) in enumerate(events)]
    df = spark.createDataFrame(
        rows, "event_id bigint, user_id bigint, ts timestamp_ntz, value double, stop boolean")
    prev, keep = _scan(rows)
    got = {r.event_id: (r.prev_value, r.diff) for r in
           O.neighbour_diff(df, "user_id", "ts", "event_id", "value", chunk_unit=unit).collect()}
    assert got == prev
    kept = {r.event_id for r in O.take_until(df, "user_id", ["ts", "event_id"],
                                             F.col("stop")).collect()}
    assert kept == keep
