"""Column expressions shared by the operators."""

from tillwork.functions.calendar import month_index, month_start, week_start
from tillwork.functions.draws import seeded_draw
from tillwork.functions.ratios import MONEY, WHOLE, average, pct, ratio

__all__ = [
    "MONEY",
    "WHOLE",
    "average",
    "month_index",
    "month_start",
    "pct",
    "ratio",
    "seeded_draw",
    "week_start",
]
