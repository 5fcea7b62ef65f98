"""Numeric helpers with the rounding behaviour of the original SQL engine.

* ``round_half_away(x, n)``: ``round(double, n)`` there scales by 10^n, rounds
  half away from zero on the *double* product and scales back.  Spark's own
  ``round`` rounds the decimal text of the double half-up, which disagrees on
  values such as 0.01045 (mean of 0.0104 and 0.0105).
* ``to_decimal(x, p, s)``: double -> DECIMAL(p, s) through the same rounding.
* ``decimal_mean(sum, count, s)``: ``avg`` of a DECIMAL(p, s) column returns a
  DOUBLE computed as double(exact sum) / count.

All are plain Catalyst expressions (codegen, no Python).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def round_half_away(c: Column, scale: int) -> Column:
    m = float(10**scale)
    scaled = F.abs(c) * F.lit(m)
    whole = F.floor(scaled).cast("double")
    # floor + (fraction >= .5) is exact, unlike floor(x + .5) just below .5
    rounded = whole + F.when(scaled - whole >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    return F.signum(c) * rounded / F.lit(m)


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return round_half_away(c.cast("double"), scale).cast(DecimalType(precision, scale))


def decimal_mean(total: Column, count: Column) -> Column:
    """Mean of a DECIMAL column as DOUBLE from its exact sum and count.

    The original engine converts the exact decimal sum to DOUBLE (correctly
    rounded) and divides by the count in DOUBLE; doing the same keeps ties
    such as 20.6637 / 6 on the same side (3.4439499999999996, not 3.44395).
    """
    return F.when(count > 0, total.cast("double") / count.cast("double"))


def pct_change(current: Column, prior: Column, scale: int = 2) -> Column:
    """(current - prior) / prior * 100 rounded; NULL when prior is NULL or 0."""
    return F.when(
        prior.isNull() | (prior == 0), F.lit(None).cast("double")
    ).otherwise(round_half_away((current - prior) / prior * F.lit(100.0), scale))
