"""Calendar helpers with the reference dialect's semantics (SQL expression builders)."""

from __future__ import annotations


def day_diff(start: str, end: str) -> str:
    """Day boundaries crossed from start to end (23:00 -> 01:00 next day is 1)."""
    return f"datediff(to_date({end}), to_date({start}))"


def day_of_week(x: str) -> str:
    """Day of week with Sunday = 0 … Saturday = 6."""
    return f"(dayofweek({x}) - 1)"


def month_start(x: str) -> str:
    """First day of the month, as a date."""
    return f"trunc(to_date({x}), 'MM')"


def add_hours(ts: str, hours: str) -> str:
    return f"timestampadd(HOUR, CAST({hours} AS INT), {ts})"
