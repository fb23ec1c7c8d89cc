"""Money and rounding rules, as SQL expression builders.

* Money is decimal.  Source doubles are cast to ``decimal(12,2)`` *before*
  any arithmetic, so line totals are exact.
* Sums of money stay exact and are normalised to ``decimal(22,2)``.
* Averages, ratios and percentiles are doubles computed as
  ``double(sum) / count`` and rounded half-up through a 6-place decimal
  (:func:`stable_round`), which makes the rounding independent of the last
  bits of a floating-point sum.

Each builder takes and returns Spark SQL expression text; :func:`E` turns
one into a Column (one JVM call, parsed and resolved by Catalyst).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
SUM_MONEY = "decimal(22,2)"
ZERO_MONEY = "CAST(0 AS DECIMAL(22,2))"
ZERO_COUNT = "CAST(0 AS BIGINT)"


def E(sql: str) -> Column:  # noqa: N802 - short on purpose, used in every projection
    return F.expr(sql)


def exprs(*sql: str) -> list[Column]:
    return [F.expr(s) for s in sql]


def money_sum(x: str) -> str:
    """Exact sum of 2-place money as ``decimal(22,2)``.

    Summed as whole cents in a ``bigint`` buffer: Spark keeps decimal sums
    wider than 18 digits as BigDecimal objects, which is several times
    slower per row.  Under ANSI mode a (practically impossible) overflow of
    the long raises instead of wrapping, so the result is never silently
    wrong."""
    return f"CAST(CAST(sum(CAST(({x}) * 100 AS BIGINT)) AS DECIMAL(20,0)) / 100 AS DECIMAL(22,2))"


def flag_sum(cond: str) -> str:
    """``sum(case when cond then 1 else 0 end)`` as bigint."""
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def stable_round(x: str, places: int) -> str:
    """Half-up rounding of a double at ``places`` digits, via decimal(28,6)."""
    return f"CAST(round(CAST(CAST(({x}) AS DOUBLE) AS DECIMAL(28,6)), {places}) AS DOUBLE)"


def ratio(num: str, den: str) -> str:
    """``double(num) / double(den)``; NULL when den is 0 or NULL."""
    return f"(CAST(({num}) AS DOUBLE) / nullif(CAST(({den}) AS DOUBLE), 0.0D))"


def pct(num: str, den: str, places: int = 2) -> str:
    """``round(100 * num / den, places)`` in double; NULL when den is 0."""
    return stable_round(f"(100.0D * CAST(({num}) AS DOUBLE)) / nullif(CAST(({den}) AS DOUBLE), 0.0D)", places)


def mean_of(x: str) -> str:
    """Aggregate mean as ``double(sum(x)) / count(x)`` (NULLs ignored)."""
    return f"(CAST(sum({x}) AS DOUBLE) / CAST(nullif(count({x}), 0) AS DOUBLE))"
