"""Sums, averages and ratios that come out the same however rows are partitioned.

Floating sums depend on the order in which partial results meet. Measures are
therefore summed as decimals that hold twelve places of every double, which is
associative, and only the final quotient is rounded, half up. A quotient of two
doubles already tells which way to round, unless it is so near to a half that
its last digits matter: only there are the decimals divided. Comparisons of
single values stay on the raw doubles.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 12
# A measure and a sum of measures. A value that is not finite or too wide counts as missing.
EXACT, SUMMED = f"decimal(32,{PLACES})", f"decimal(38,{PLACES})"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def fixed(value: Column | str) -> Column:
    """Number as an exact decimal; null for infinities, NaN and values beyond 1e20."""
    return _col(value).try_cast(EXACT)


def unfixed(exact: Column | str) -> Column:
    return _col(exact).cast("double")


# Bounds the relative error of a quotient of doubles cast from decimals, and of that times a power of ten.
DOUBT = 1e-15
# Quotients from here on leave a double no digits to round.
WIDE = 1e14


def _half_up(numerator: Column, denominator: Column, shift: int, digits: int) -> Column:
    """numerator * 10**shift / denominator, rounded half up to whole units, as units of 10**-digits.

    Near a half, the double's whole part is right, and the remainder of an exact division tells on which side of the
    half the quotient is. Divisors may have 16 digits before the point there. The expression is kept short, as a
    method of many thousand bytecodes is not compiled.
    """
    below = F.nullif(denominator.cast("double"), F.lit(0.0))
    quotient = numerator.cast("double") / below * float(10**shift)
    size = F.abs(quotient)
    whole = F.floor(size)
    part = size - whole
    step = F.abs(F.nullif(denominator.cast(EXACT), F.lit(0).cast(EXACT)))
    rest = (F.abs(numerator.cast(SUMMED)) % step).try_cast(f"decimal(28,{PLACES})") * F.lit(Decimal(10**shift))
    up = F.when(F.abs(part - 0.5) > size * DOUBT, part > 0.5).otherwise((rest % step) * F.lit(Decimal(2)) >= step)
    units = F.when(size >= WIDE, size).otherwise((whole + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("double"))
    # Units of zero have no sign.
    return F.when(quotient < 0, F.lit(0.0) - units).otherwise(units) / float(10**digits)


def ratio(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    """Quotient of two numbers, rounded half up; null for a zero denominator."""
    return _half_up(_col(numerator), _col(denominator), digits, digits)


def percent(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    return _half_up(_col(numerator), _col(denominator), digits + 2, digits)


def mean(total: Column | str, count: Column | str, digits: int) -> Column:
    """Average from an exact sum and a row count."""
    return ratio(total, count, digits)
