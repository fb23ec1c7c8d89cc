"""Scalar helpers shared by the models: SQL expression builders for the
money / rounding rules and the dialect's calendar semantics."""

from tillbook.functions.dates import add_hours, day_diff, day_of_week, month_start
from tillbook.functions.numeric import (
    MONEY,
    SUM_MONEY,
    ZERO_COUNT,
    ZERO_MONEY,
    E,
    exprs,
    flag_sum,
    mean_of,
    money_sum,
    pct,
    ratio,
    stable_round,
)

__all__ = [
    "MONEY",
    "SUM_MONEY",
    "ZERO_COUNT",
    "ZERO_MONEY",
    "E",
    "add_hours",
    "day_diff",
    "day_of_week",
    "exprs",
    "flag_sum",
    "mean_of",
    "money_sum",
    "month_start",
    "pct",
    "ratio",
    "stable_round",
]
