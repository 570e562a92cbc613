"""``Column`` builders for the scalar rules.

Every function here returns a ``Column`` made only of built-in expressions, so
it is evaluated inside whole-stage codegen on the executors; nothing calls
back into Python per row.  Arguments accept a column name or a ``Column``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# ---------------------------------------------------------------------------
# Fixed values (they decide results, so they are stated here as plain text).
#
# Grade ladder, strict ">" and first match wins:
#   A above 90, AB above 85, B above 80, BC above 75, C above 70, else D.
GRADE_LADDER: tuple[tuple[float, str], ...] = (
    (90, "A"), (85, "AB"), (80, "B"), (75, "BC"), (70, "C"))
GRADE_FLOOR = "D"
# Weight/height^2 bands, half-open, lower bound included:
#   below 18.5 underweight, [18.5, 23) normal, [23, 25) overweight,
#   25 and above obese.
RATIO_BANDS: tuple[tuple[float, str], ...] = (
    (25.0, "obese"), (23.0, "overweight"), (18.5, "normal"))
RATIO_FLOOR = "underweight"
# Pass mark: a score at or below it does not pass.
PASS_MARK = 50
# ---------------------------------------------------------------------------


def _c(x: ColumnOrName | float | int) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


# --- sales rules (P2-P9) ----------------------------------------------------

def line_total(quantity: ColumnOrName, unit_price: ColumnOrName) -> Column:
    """Line amount as double: 0.0 when the quantity is missing.

    A missing *price* with a quantity still gives null, as in the source rule.
    """
    q, p = _c(quantity), _c(unit_price)
    return F.when(q.isNull(), F.lit(0.0)).otherwise((q * p).cast("double"))


def repair_text(text: ColumnOrName, bad: str, good: str) -> Column:
    """Literal (not regex) replacement of every ``bad`` by ``good``."""
    return F.replace(_c(text), F.lit(bad), F.lit(good))


def full_name(first: ColumnOrName, last: ColumnOrName, sep: str = " ") -> Column:
    """``first || sep || last``; null when either part is null (P5)."""
    return F.concat(_c(first), F.lit(sep), _c(last))


def day_of(ts: ColumnOrName) -> Column:
    """Calendar day of a timestamp, as a ``date``."""
    return F.to_date(_c(ts))


def money_round(x: ColumnOrName, scale: int = 2) -> Column:
    """Half-away-from-zero rounding."""
    return F.round(_c(x), scale)


# --- banding and formulas (R1-R6) ------------------------------------------

def grade(score: ColumnOrName,
          ladder: Sequence[tuple[float, str]] = GRADE_LADDER,
          floor_label: str = GRADE_FLOOR) -> Column:
    """Grade ladder with strict ``>`` thresholds, first match wins."""
    s = _c(score)
    out = None
    for threshold, label in ladder:
        cond = s > F.lit(threshold)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(s.isNull(), F.lit(None).cast("string")).otherwise(
        out.otherwise(F.lit(floor_label)))


def mass_ratio(weight_kg: ColumnOrName, height_cm: ColumnOrName) -> Column:
    """weight / height^2 with the height given in centimetres (R2).

    Written as a product, not ``pow``, so the value is reproducible across
    engines to the last bit.
    """
    h = _c(height_cm).cast("double") / F.lit(100.0)
    return _c(weight_kg).cast("double") / (h * h)


def ratio_band(ratio: ColumnOrName,
               bands: Sequence[tuple[float, str]] = RATIO_BANDS,
               floor_label: str = RATIO_FLOOR) -> Column:
    """Half-open bands, lower bound included, highest band first (R2)."""
    r = _c(ratio)
    out = None
    for lower, label in bands:
        cond = r >= F.lit(lower)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(r.isNull(), F.lit(None).cast("string")).otherwise(
        out.otherwise(F.lit(floor_label)))


def compound_growth(principal: ColumnOrName, rate: ColumnOrName | float,
                    periods: ColumnOrName | int) -> Column:
    """``p * (1 + r) ** t``."""
    return _c(principal) * F.pow(F.lit(1.0) + _c(rate), _c(periods))


def _as_decimal(x: Column, kind: str) -> Column:
    """``x`` as a decimal that holds it in full, null where it doesn't fit."""
    d = x.try_cast(kind)
    return F.when(d.cast("double") == x.cast("double"), d)


def simple_interest(principal: ColumnOrName, rate: ColumnOrName | float,
                    periods: ColumnOrName | int, scale: int = 2) -> Column:
    """``p * (1 + r * t)``, rounded at the end, as double.

    In decimal arithmetic, and so exact before rounding, where the principal
    has up to four decimal places (and 14 before), the rate twelve and the
    periods six.  Other values keep all digits of a double: ``p + p * r * t``
    in double arithmetic, then rounded.  Nothing is cut or refused.
    """
    p, r, t = _c(principal), _c(rate), _c(periods)
    exact = _as_decimal(p, "decimal(18,4)") * (
        F.lit(1).cast("decimal(1,0)") + _as_decimal(r, "decimal(18,12)") * _as_decimal(t, "decimal(12,6)"))
    pd = p.cast("double")
    return F.coalesce(F.round(exact, scale).cast("double"),
                      F.round(pd + pd * r.cast("double") * t.cast("double"), scale))


def goal_shortfall(total: ColumnOrName, goal: ColumnOrName | float) -> Column:
    """0 when the goal is reached, else how much is missing.

    The amounts are compared as they are; the difference is exact (decimal)
    where both have up to twelve decimal places and 18 before, else that of
    doubles.
    """
    tot, g = _c(total), _c(goal)
    exact = _as_decimal(g, "decimal(30,12)") - _as_decimal(tot, "decimal(30,12)")
    missing = F.coalesce(exact.cast("double"), g.cast("double") - tot.cast("double"))
    return F.when(tot >= g, F.lit(0.0)).otherwise(missing)


def equal_split(amount: ColumnOrName, parts: ColumnOrName | int) -> Column:
    """Whole units each of ``parts`` receivers gets: ``int(a / n)``, cut
    toward zero (R6)."""
    return (_c(amount).cast("double") / _c(parts).cast("double")).cast("bigint")


def arith_term(first: ColumnOrName, step: ColumnOrName, n: ColumnOrName) -> Column:
    """n-th term of an arithmetic sequence, ``a + (n - 1) * b``."""
    return _c(first) + (_c(n) - F.lit(1)) * _c(step)


# --- predicates and text (R7, R8, R11-R13) ----------------------------------

def is_not_value(col: ColumnOrName, value, keep_nulls: bool = True) -> Column:
    """Row filter that skips one value (R7); nulls are kept unless asked."""
    c = _c(col)
    return ~c.eqNullSafe(F.lit(value)) if keep_nulls else c != F.lit(value)


def templated_message(name: ColumnOrName, template: str,
                      special_template: str | None = None,
                      special_values: Sequence[str] = (),
                      special_if: Column | None = None) -> Column:
    """``template % name``; ``special_template`` where the name is one of
    ``special_values`` or where ``special_if`` holds (R8).

    Templates use ``%s`` placeholders (``format_string``).  A null name gives
    a null message.
    """
    n = _c(name)

    def said(text: str) -> Column:
        return F.when(n.isNotNull(), F.format_string(text, n))

    general = said(template)
    if special_template is None:
        return general
    cond = special_if
    if special_values:
        in_list = n.isin(list(special_values))
        cond = in_list if cond is None else (cond | in_list)
    if cond is None:
        return general
    return F.when(F.coalesce(cond, F.lit(False)),
                  said(special_template)).otherwise(general)


def char_at(text: ColumnOrName, index0: int) -> Column:
    """Character at a 0-based index, from the end if negative; empty string
    outside the text (R11)."""
    return F.substring(_c(text), index0 + 1 if index0 >= 0 else index0, 1)


def is_truthy_text(text: ColumnOrName) -> Column:
    """Non-empty string."""
    return F.length(_c(text)) > F.lit(0)


def is_truthy_number(x: ColumnOrName) -> Column:
    """Non-zero number."""
    return _c(x) != F.lit(0)


def is_truthy_array(a: ColumnOrName) -> Column:
    """Non-empty array."""
    return F.array_size(_c(a)) > F.lit(0)


def comparison_flags(left: ColumnOrName, right: ColumnOrName | float) -> dict[str, Column]:
    """All six comparisons as boolean columns."""
    a, b = _c(left), _c(right)
    return {"eq": a == b, "ne": a != b, "lt": a < b,
            "le": a <= b, "gt": a > b, "ge": a >= b}
