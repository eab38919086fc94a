"""Calendar keys and durations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_HOUR = 3_600
SECONDS_PER_DAY = 86_400


def date_key(when: Column | str) -> Column:
    """YYYYMMDD as INT, by arithmetic (no formatting and re-parsing of text)."""
    day = F.to_date(when)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_key(when: Column | str, first: dt.date, last: dt.date) -> Column:
    """Key of the calendar row for a timestamp, NULL outside [first, last].

    Equals a left join to a gap-free calendar over that range.
    """
    day = F.to_date(when)
    return F.when(day.between(F.lit(first), F.lit(last)), date_key(when))


def month_of_key(key: Column | str) -> Column:
    """yyyymm of a YYYYMMDD key; 0 for a NULL key, so it can serve as a partition value."""
    col = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.floor(col / F.lit(100)).cast("int"), F.lit(0))


def _elapsed(start: Column | str, end: Column | str, unit: int) -> Column:
    """Elapsed time in units of so many seconds; zone-less, so no session zone can shift it. From year 1 to 9999 are fewer than 10^8 hours."""
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    seconds = (end - start).cast("interval second").cast("decimal(18,6)")
    return F.round(seconds / F.lit(unit).cast("decimal(5,0)"), 2).cast("decimal(10,2)")


def hours_between(start: str, end: str) -> Column:
    """Hours from start to end, two digits; NULL when either is missing or the order is reversed."""
    return F.when(F.col(end) >= F.col(start), _elapsed(start, end, SECONDS_PER_HOUR))


def days_between(start: str, end: str) -> Column:
    """Signed days from start to end, two digits; negative when end comes first."""
    return _elapsed(start, end, SECONDS_PER_DAY)
