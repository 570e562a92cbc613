"""Sums of doubles that don't depend on the order of the rows.

Adding doubles rounds at every step, so a sum changes with the order in which
tasks and partial aggregates are merged, and a rounded report may show another
cent from run to run.  Here a double is cut, without error, into *limbs* of 24
bits at fixed places (``PLACES``); limbs are whole numbers, their sums in longs
are exact in any order, and only the end result becomes a double again.

All values below 2^62 and with no bit under 2^-72 (every double from 2^-20 on)
count in full; what a smaller value has under 2^-72 is cut off, alike in any
order.  A limb's sum holds 2^39 rows of full limbs, and an overflow is an
error, never a wrong sum.  Nulls are skipped, a group without a value gives
null.  Infinities, NaN and values of 2^62 and more are added as doubles beside
the limbs: the first two are still the same in any order.

``sum_parts`` and ``merged_parts`` give partial sums as columns, for
aggregates in several steps or kept in a table; ``exact_sum`` does all in one.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LIMB = 24
# A limb's place: the power of two that one unit of it is worth.
PLACES = (24, 0, -24, -48, -72)
_LARGE = 2.0 ** 62
_ODD = "odd"


def _value(x: Column | str) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def _limb(x: Column, place: int) -> Column:
    """The whole number that the bits of ``x`` from ``place`` on make, signed.
    Scaling by a power of two, ``%`` and ``floor`` are all exact here."""
    scaled = F.abs(x) * F.lit(2.0 ** -place)
    if place != PLACES[0]:  # the topmost limb takes all that lies above
        scaled = scaled % F.lit(2.0 ** LIMB)
    whole = F.floor(scaled)
    return F.when(x < 0, -whole).otherwise(whole)


def _parts(x: Column) -> list[Column]:
    usual = F.abs(x) < _LARGE  # false for NaN too
    return [F.sum(F.when(usual, _limb(x, p))) for p in PLACES] + [F.sum(F.when(~usual, x))]


def _names(prefix: str) -> list[str]:
    return [f"{prefix}_{k}" for k in (*range(len(PLACES)), _ODD)]


def sum_parts(x: Column | str, prefix: str) -> list[Column]:
    """Aggregates of ``x`` named by ``prefix``: limb sums and the odd values."""
    return [c.alias(n) for c, n in zip(_parts(_value(x)), _names(prefix))]


def merged_parts(prefix: str) -> list[Column]:
    """Aggregates that add up the partial sums of ``sum_parts``."""
    return [F.sum(n).alias(n) for n in _names(prefix)]


def _total(parts: list[Column]) -> Column:
    *limbs, odd = parts
    unit = F.lit(1 << LIMB)
    # carry upwards, so that each limb but the topmost lies in [0, 2^24)
    carried: list[Column] = []
    carry = F.lit(0).cast("bigint")
    for limb in reversed(limbs[1:]):
        now = limb + carry
        carried.insert(0, F.pmod(now, unit))
        carry = F.shiftright(now, LIMB)
    low = F.lit(0.0)
    for place, limb in reversed(list(zip(PLACES[1:], carried))):
        low = low + limb.cast("double") * F.lit(2.0 ** place)
    exact = (limbs[0] + carry).cast("double") * F.lit(2.0 ** PLACES[0]) + low
    return F.when(odd.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + odd)


def sum_of_parts(prefix: str) -> Column:
    """The double that the partial sums named by ``prefix`` stand for."""
    return _total([F.col(n) for n in _names(prefix)])


def exact_sum(x: Column | str) -> Column:
    """An aggregate: the sum of ``x`` as a double, whatever the order."""
    return _total(_parts(_value(x)))
