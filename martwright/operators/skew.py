"""Joins with heavy keys spread over several tasks by their row counts.

AQE splits a join partition by its bytes, above a bound, and only on a side
that the join type allows.  Narrow rows (two ids and a price) stay below the
bound while one key already has a third of the rows in one task.  Here heavy
keys are found first, by a frequency sketch of bounded size, and only their
rows are salted: the left side's rows of a heavy key are dealt into as many
salts as its share asks for, the right side's rows of that key are copied for
each salt.  All other keys keep the salt 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

TRACKED = 8192  # keys that the sketch tracks: its error is at most rows / 8192 or so
SHARE = 0.01  # of the left rows: a key above it is heavy, so there are at most 100
SPREAD = 0.005  # of the left rows that one salt takes, about


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> tuple[dict, int]:
    """``({key: rows}, all rows)``: the keys with more than ``share`` of the
    rows of ``df``, nulls left out (they join with nothing).

    One scan of the key column.  The sketch (frequent items) is merged in
    partial aggregates and keeps at most ``tracked`` keys, so what reaches the
    driver is bounded by 1/``share`` keys.  Estimates err by about
    rows/``tracked``; a key near the bound may be taken or not, which changes
    how rows are dealt and never the result.
    """
    if share * tracked < 4:
        raise ValueError("the sketch tracks too few keys for this share")
    most = math.ceil(1 / share)
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    return {r["item"]: r["count"] for r in found["top"] or [] if r["count"] > share * found["n"]}, found["n"]


def salts_for(heavy: dict, total: int, spread: float = SPREAD) -> dict:
    """How many salts each heavy key gets."""
    return {k: max(2, math.ceil(n / max(1, spread * total))) for k, n in heavy.items()}


def salted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", share: float = SHARE,
                spread: float = SPREAD, tracked: int = TRACKED) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` inner or left, with the heavy
    keys of ``left`` spread over several tasks.

    ``left`` is scanned once more for the key column.  The right side grows by
    the copies of the heavy keys' rows, at most 1/``spread`` of them.  A row's salt
    is a hash of the whole row, so a task that runs again deals alike;
    rows that are equal in all columns share a salt.  Without heavy keys this
    is the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can copy the right side")
    if "_salt" in (c.lower() for c in (*left.columns, *right.columns)):
        raise ValueError("the column name _salt is taken")
    heavy, total = heavy_keys(left, key, share, tracked)
    if not heavy:
        return left.join(right, key, how)
    salts = salts_for(heavy, total, spread)
    kind = left.schema[key].dataType
    number = F.element_at(F.create_map(*[x for k, n in salts.items() for x in (F.lit(k).cast(kind), F.lit(n))]),
                          F.col(key).cast(kind))
    number = F.coalesce(F.when(F.col(key).isNotNull(), number), F.lit(1))
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]),
                                            number.cast("bigint")).cast("int"))
    copied = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), number.cast("int") - 1)))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
