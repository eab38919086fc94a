"""Exact decimal ratios; rounding is half away from zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL when den is zero."""
    den = _col(den)
    return _col(num) / F.nullif(den, F.lit(0).cast("bigint"))


def exact_avg(col: Column | str, digits: int) -> Column:
    """Mean of a decimal or integer column, rounded once.

    avg() over decimal(12,2) already rounds to six digits, so rounding it again could differ.
    """
    total = F.sum(_col(col).cast("decimal(22,2)"))
    return F.round(total / F.nullif(F.count(col), F.lit(0).cast("bigint")).cast("decimal(20,0)"), digits)


def pct(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """100 * part / whole on decimals, rounded; NULL when whole is zero or NULL."""
    part = _col(part).cast("decimal(22,2)")
    whole = _col(whole).cast("decimal(22,2)")
    return F.round(F.lit(100) * part / F.nullif(whole, F.lit(0).cast("decimal(22,2)")), digits)


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    """Aggregate: sum(value * weight) / sum(weight)."""
    value, weight = _col(value), _col(weight)
    return F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0).cast("bigint"))
