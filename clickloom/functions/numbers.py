"""Ratios rounded to two decimals."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# From 2^52 on a double has no digits after the point; below 2^46 a hundredfold fits one exactly.
_WHOLE, _HUNDREDFOLD = 4503599627370496.0, 70368744177664.0
# Whether the double nearest to (2 i + 1) / 200, halfway between i and i + 1 cents, lies below it.
_BELOW = [Fraction((2 * i + 1) / 200) < Fraction(2 * i + 1, 200) for i in range(101)]


def round_half_up(x: Column) -> Column:
    """Round a double half up to two decimals by its exact binary value.

    ``round(0.015D, 2)`` gives 0.02 because Spark rounds the shortest decimal text; the double
    itself lies just under 0.015, and the result wanted here is 0.01. The whole part is split
    off, which is exact, and the fraction is rounded: ``floor(100 x + 0.5)`` can be off by one
    cent, so the fraction is compared with the doubles nearest to the halves on both sides. A
    fraction other than these is on the same side of the half as of the double; for an equal one a
    table of the 101 halves tells. NaN and infinity become NULL, a negative zero 0.
    """
    x = x.cast("double")
    a = F.abs(x)
    known = F.when(a < _WHOLE, a).otherwise(0.0)
    whole = F.floor(known).cast("double")
    part = known - whole
    cents = F.floor(part * 100 + 0.5)
    below = F.array(*map(F.lit, _BELOW))
    low, high = (cents * 2 - 1) / F.lit(200.0), (cents * 2 + 1) / F.lit(200.0)
    less = (part < low) | ((part == low) & F.get(below, (cents - 1).cast("int")))
    more = (part > high) | ((part == high) & ~F.get(below, cents.cast("int")))
    exact = (cents - less.cast("int") + more.cast("int")).cast("double")
    # One division gives the double nearest to the result, if a hundredfold fits.
    scale = F.when(known < _HUNDREDFOLD, 100.0).otherwise(1.0)
    rounded = (whole * scale + exact * scale / 100) / scale
    # Terms instead of branches: Spark computes what is shared by all branches of a CASE anew in each,
    # and a method that grew too long is not compiled. The sum with zero has no negative zero.
    rest = F.when(F.isnan(x) | (a == float("inf")), None).when(a < _WHOLE, 0.0).otherwise(x)
    return rounded * F.signum(x) + rest


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient of two counts to two decimals; NULL when the denominator is zero."""
    return round_half_up(F.try_divide(numerator.cast("double"), denominator.cast("double")))
