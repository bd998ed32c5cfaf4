"""Column helpers for ratios, guarded division and rounding.

All helpers return ``Column`` expressions built from built-in functions,
so they stay inside whole-stage codegen.

The original computes in exact decimals: ``ROUND`` rounds half away from
zero, and a value lying exactly half-way matters.  Quotients and means are
therefore rounded with integer arithmetic where the original rounds them
(``pct_half_up``, ``pct_decimal``, ``div_half_up``, ``mean_half_up``):
``round(a / b) = (2a + b) div 2b`` for non-negative integers.  Sums over
the fact are exact integers (``sum_units``).  DOUBLE is used where the
original uses it too (the report measures) or for values that are not
rounded; ``round_half_up`` then applies one fixed sequence of IEEE
operations, so every engine gets the same bits.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """``num / NULLIF(den, 0)`` as DOUBLE; NULL when the divisor is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(part, whole) -> Column:
    """Percentage ``part * 100 / NULLIF(whole, 0)`` computed in DOUBLE.

    The multiplication comes before the division, in that order, so the
    result is bit-identical to the same SQL expression in other engines.
    """
    return _c(part).cast("double") * F.lit(100.0) / F.nullif(_c(whole).cast("double"), F.lit(0.0))


def round_half_up(x, digits: int) -> Column:
    """Round half away from zero to ``digits`` places, returning DOUBLE.

    ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.  For DECIMAL input the
    floor is exact, so the result is the double nearest to the exact
    decimal rounding.  For DOUBLE input every step is a single IEEE
    operation, which makes the result independent of the engine.  The
    trailing ``+ 0.0`` turns ``-0.0`` into ``0.0``.
    """
    c = _c(x)
    # DECIMAL literals keep a DECIMAL input exact up to the floor; with a
    # DOUBLE input Spark widens them to DOUBLE.
    scale = F.lit(Decimal(10) ** digits)
    return (F.signum(c) * F.floor(F.abs(c) * scale + F.lit(Decimal("0.5"))) / scale) + F.lit(0.0)


def mean_exact(x, scale: int | None = None) -> Column:
    """Unweighted mean that does not depend on summation order.

    With ``scale`` the values are first cast to DECIMAL(38-?, scale), so the
    sum is exact; use it for values already rounded to ``scale`` places.
    The sum is then turned into DOUBLE and divided by the non-null count.
    """
    c = _c(x)
    if scale is not None:
        c = c.cast(f"decimal(30,{scale})")
    return F.sum(c).cast("double") / F.nullif(F.count(c).cast("double"), F.lit(0.0))


def dax_divide(num, den, alternate: float = 0.0) -> Column:
    """DAX ``DIVIDE(num, den, alternate)``: the alternate when ``den`` is 0 or NULL (blank)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(F.coalesce(d, F.lit(0.0)) == 0, F.lit(float(alternate))).otherwise(n / F.nullif(d, F.lit(0.0)))


def mean_parts(x, scale: int, name: str) -> list[Column]:
    """Aggregates for an exactly rounded mean of values with ``scale``
    decimals: the sum of ``value * 10^scale`` as an integer, and the count.
    Finish with ``mean_half_up(name, scale)`` after the aggregation."""
    c = _c(x)
    return [F.sum((c * F.lit(Decimal(10) ** scale)).cast("decimal(38,0)")).alias(f"_{name}_s"),
            F.count(c).alias(f"_{name}_n")]


def mean_half_up(name: str, scale: int, digits: int | None = None) -> Column:
    """``ROUND(AVG(x), digits)`` with exact decimal semantics, as DOUBLE.

    With S the integer sum (units of ``10^-scale``) and n the count from
    ``mean_parts``, the mean in units of ``10^-digits`` rounded half away
    from zero is ``sign(S) * ((2|S| + n*f) div (2*n*f))`` with
    ``f = 10^(scale - digits)``: integer arithmetic, so a mean lying exactly
    half-way rounds away from zero, as decimal AVG + ROUND do.  Dividing
    the mean as a double first would round about one in eleven such ties
    the wrong way.
    """
    d = scale if digits is None else digits
    f = 10 ** (scale - d)
    s, n = f"_{name}_s", f"_{name}_n"
    q = F.expr(f"(2 * abs({s}) + {n} * {f}) div nullif(2 * {n} * {f}, 0)")
    return (F.signum(F.col(s)) * q).cast("double") / F.lit(float(10 ** d)) + F.lit(0.0)


# Fixed value: percentages of two counts carry 5 decimal places, as the
# original MySQL arithmetic gives for ``a * 100.0 / b``.
PCT_SCALE = 5


def pct_units(part: str, whole: str, digits: int) -> Column:
    """``ROUND(part * 100.0 / NULLIF(whole, 0), digits) * 10^digits`` as an
    exact LONG: ``(2 * 100 * 10^d * |part| + |whole|) div (2 * |whole|)``
    with the sign of the quotient.  ``part`` and ``whole`` are column names
    of integral columns."""
    k = 2 * 100 * 10 ** digits
    a, b = (f"abs(CAST({c} AS DECIMAL(38,0)))" for c in (part, whole))  # no overflow at any count
    q = F.expr(f"(CAST({k} AS DECIMAL(38,0)) * {a} + {b}) div nullif(2 * {b}, 0)")
    return F.when((F.col(part) < 0) != (F.col(whole) < 0), -q).otherwise(q)


def pct_half_up(part: str, whole: str, digits: int = 2) -> Column:
    """``ROUND(part * 100.0 / NULLIF(whole, 0), digits)`` for integer counts,
    exactly, as DOUBLE.  Counts give ratios such as 23 of 4000 = 0.575 %
    whose decimal value is a tie that a DOUBLE quotient misses; integer
    arithmetic rounds it away from zero, as the decimal SQL does."""
    return pct_units(part, whole, digits).cast("double") / F.lit(float(10 ** digits)) + F.lit(0.0)


def pct_decimal(part: str, whole: str, digits: int = PCT_SCALE) -> Column:
    """The percentage of two counts as an exact DECIMAL with ``digits``
    places (5 by default, the original's precision)."""
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (pct_units(part, whole, digits).cast("decimal(20,0)") * unit).cast(f"decimal(20,{digits})")


def div_half_up(num: str, den: str, digits: int, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), digits)`` for decimals with at most
    ``scale`` places (money and weight have 2), exactly, as DOUBLE.

    Both sides become exact integer counts of ``10^-scale`` as DECIMAL(38,0)
    (a BIGINT product overflows for a group of 4.6e12 EUR), then
    ``sign * ((2 * 10^d * |A| + |B|) div (2 * |B|)) / 10^d``: a quotient
    lying half-way rounds away from zero as the decimal SQL does (a DOUBLE
    quotient can miss it).
    """
    k = 2 * 10 ** digits
    a, b = (f"abs(CAST({c} * {10 ** scale} AS DECIMAL(38,0)))" for c in (num, den))
    q = F.expr(f"(CAST({k} AS DECIMAL(38,0)) * {a} + {b}) div nullif(2 * {b}, 0)")
    signed = F.when((F.col(num) < 0) != (F.col(den) < 0), -q).otherwise(q)
    return signed.cast("double") / F.lit(float(10 ** digits)) + F.lit(0.0)


def sum_units(x, scale: int = 2) -> Column:
    """Exact sum of a decimal column with at most ``scale`` places, as an
    integer count of ``10^-scale`` (cents for money) in DECIMAL(28,0): no group
    is too large for it, and the order of additions does not matter."""
    c = F.col(x) if isinstance(x, str) else x
    return F.sum((c * F.lit(Decimal(10) ** scale)).cast("decimal(18,0)"))


def from_units(x, scale: int = 2, precision: int = 20) -> Column:
    """An integer count of ``10^-scale`` back to DECIMAL(precision, scale)."""
    c = F.col(x) if isinstance(x, str) else x
    return (c.cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal({precision},{scale})")
