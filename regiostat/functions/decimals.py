"""Decimal helpers.

Statistics are stored as ``decimal(20,2)`` at every level of the hierarchy,
so each level rounds before the next one sums.  The weighted mean
``sum / count`` is rounded half away from zero on exact integers (cents),
which is what a numeric division followed by a ``numeric(20,2)`` store does;
Spark's own decimal division would first round to 6+ digits and could round
twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiostat.config import STAT_DECIMAL


def to_stat(c: Column | str) -> Column:
    """Store a value as the statistics decimal type (half-up rounding)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(STAT_DECIMAL)


def double_to_stat(c: Column | str) -> Column:
    """Store a double statistic (stddev) as ``decimal(20,2)``.

    The double is first fixed to 6 places and then rounded half-up to 2, so
    results that sit on a ``.xx5`` boundary up to floating noise round the
    same way whichever algorithm produced the double.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("decimal(38,6)").cast(STAT_DECIMAL)


def exact_mean_sql(sum_expr: str, count_expr: str) -> str:
    """SQL text: ``sum/count`` rounded half away from zero to 2 places.

    ``sum_expr`` is a decimal with scale <= 2, ``count_expr`` an integer.
    NULL when either side is NULL or the count is 0.
    """
    s, n = f"({sum_expr})", f"({count_expr})"
    cents = f"abs(CAST({s} * 100 AS DECIMAL(38,0)))"
    q = f"(({cents} * 2 + {n}) div (CAST({n} AS DECIMAL(38,0)) * 2))"
    return (f"CAST(CAST(CASE WHEN {n} IS NULL OR {n} = 0 OR {s} IS NULL THEN NULL "
            f"WHEN {s} < 0 THEN -{q} ELSE {q} END AS DECIMAL(38,0)) * 0.01 AS {STAT_DECIMAL})")


def exact_mean(sum_col: str, count_col: str) -> Column:
    """Column version of :func:`exact_mean_sql` over two column names."""
    return F.expr(exact_mean_sql(f"`{sum_col}`", f"`{count_col}`"))
