"""Units and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Unit factors used by the weather providers' fields.
FEET_PER_MILE = 5280.0
METERS_PER_MILE = 1609.34


def c_to_f(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def feet_to_miles(feet: Column) -> Column:
    return feet / F.lit(FEET_PER_MILE)


def meters_to_miles(meters: Column) -> Column:
    return meters / F.lit(METERS_PER_MILE)


def fraction_to_pct(fraction: Column) -> Column:
    return fraction * 100


def py_round(x: Column, digits: int) -> Column:
    """Round the exact binary value to ``digits`` decimals, ties to even.

    Spark's ``round`` rounds the shortest decimal text half up, so 1.015 gives
    1.02; the binary value lies below the tie and belongs at 1.01.  The product
    with the power of ten is formed with its rounding error (the factor has so
    few bits that splitting ``x`` once makes both partial products exact), and
    the error decides ties.
    """
    if not 0 <= digits <= 6:
        raise ValueError("digits must be between 0 and 6")
    scale = F.lit(float(10 ** digits))
    big = x * F.lit(134217729.0)
    high = big - (big - x)
    low = x - high
    product = x * scale
    error = (high * scale - product) + low * scale
    whole = F.floor(product)
    part = product - whole.cast("double")
    up = (part > 0.5) | (
        (part == 0.5) & ((error > 0) | ((error == 0) & (F.pmod(whole, F.lit(2)) == 1)))
    )
    rounded = (whole + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("double") / scale
    return F.when(F.isnan(x) | (F.abs(product) >= 4503599627370496.0), x).otherwise(rounded)
