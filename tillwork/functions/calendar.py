"""Calendar buckets that do not depend on session settings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(moment: Column, datefirst: int = 1) -> Column:
    """First day of the week holding ``moment``.

    ``datefirst`` names the weekday that opens a week, 1 = Monday … 7 = Sunday.
    """
    if not 1 <= datefirst <= 7:
        raise ValueError("datefirst must be between 1 (Monday) and 7 (Sunday)")
    day = moment.cast("date")
    days_into_week = F.pmod(F.dayofweek(day) - F.lit(1 + datefirst % 7), F.lit(7))
    return F.date_sub(day, days_into_week)


def month_start(moment: Column) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(moment.cast("date"), "MM")


def month_index(first: Column, later: Column) -> Column:
    """Number of month boundaries between two dates; 31 Jan → 1 Feb is 1."""
    return (F.year(later) - F.year(first)) * 12 + F.month(later) - F.month(first)
