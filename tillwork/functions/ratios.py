"""Exact decimal ratios.

Rates are divided as decimals and rounded once, half away from zero, so a value
such as 23 of 4,000 gives 0.58 percent and not the 0.57 that doubles yield.  A
zero denominator gives NULL.  A cast that does not fit fails the query, so results
that no total bounds get types wide enough for a group with most of the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operand types.  Narrow enough that a quotient keeps at least 14 decimals
# within Spark's 38 digits.
WHOLE = "decimal(20,0)"
MONEY = "decimal(24,4)"


def ratio(
    num: Column, den: Column, result: str, num_type: str = WHOLE, den_type: str = WHOLE
) -> Column:
    """``num / den`` as the decimal type ``result``."""
    divisor = den.cast(den_type)
    return F.when(divisor != 0, num.cast(num_type) / divisor).cast(result)


def pct(num: Column, den: Column, scale: int = 2, precision: int = 10) -> Column:
    """100 * num / den of two counts, as decimal(precision, scale)."""
    return ratio(num.cast(WHOLE) * 100, den, f"decimal({precision},{scale})", "decimal(24,0)")


def average(total: Column, n: Column, result: str) -> Column:
    """Mean of a money total over a count."""
    return ratio(total, n, result, num_type=MONEY)
