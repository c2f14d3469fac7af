"""Guarded arithmetic and stable hashing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from leavewatch import fixed_values as fixed


def guarded_ratio(top: Column, bottom: Column, floor: int = 0) -> Column:
    """``top / bottom``, or 0 when ``bottom`` is not above ``floor``."""
    return F.when(bottom <= floor, F.lit(0.0)).otherwise(F.try_divide(top, bottom))


def hours(seconds: Column) -> Column:
    return seconds / fixed.SECONDS_PER_HOUR


def sign_colour(value: Column) -> Column:
    """``red`` for a negative value, ``blue`` for any other."""
    return F.when(F.signum(value) == -1, F.lit("red")).otherwise(F.lit("blue"))


def stable_hash(key: Column, salt: str = "") -> Column:
    """A number below 2**32 that depends on the key and the salt alone.

    Unlike a random split it does not change with partitioning, row order or
    a recomputed task.
    """
    salted = F.concat(F.lit(salt), key) if salt else key
    return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")


def hash_percent(key: Column, salt: str = "") -> Column:
    """A stable number from 0 to 99."""
    return (stable_hash(key, salt) % 100).cast("int")


def student_975(freedom: Column) -> Column:
    """0.975 quantile of Student's t; null below one degree of freedom.

    Listed values up to 9 degrees, then the expansion around the normal
    quantile (Abramowitz and Stegun 26.7.5), which is good to 1e-5 from 10 on.
    """
    z = fixed.NORMAL_975
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    v = freedom.cast("double")
    series = F.lit(z)
    for power, term in enumerate(terms, start=1):
        series = series + F.try_divide(F.lit(term), F.pow(v, F.lit(float(power))))
    quantile = F.when(v < 1, F.lit(None).cast("double"))
    for degrees, value in fixed.STUDENT_975.items():
        quantile = quantile.when(v == degrees, F.lit(value))
    return quantile.otherwise(series)
