"""Date spines and gap filling."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MAX_SPINE_DAYS = 366 * 1000


def _check_length(first: dt.date, last: dt.date) -> None:
    if (last - first).days > MAX_SPINE_DAYS:
        raise ValueError(f"a calendar from {first} to {last} is too long: give its ends (--first-day, --last-day); rows outside get no date key")


def day_spine(spark: SparkSession, first: dt.date, last: dt.date, name: str = "full_date") -> DataFrame:
    """One row per day; the length is checked because spines are broadcast."""
    _check_length(first, last)
    days = F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias(name))


def calendar_columns(star: Mapping[str, DataFrame], *columns: str, key: str = "date_key") -> DataFrame:
    """Calendar key and attributes for a map-side join: the calendar's length was checked when it was built.

    A shuffle join on the key would send all facts of a busy day to one task.
    """
    return F.broadcast(star["dim_date"].select(F.col("date_key").alias(key), *columns))


def month_spine(spark: SparkSession, first: dt.date, last: dt.date, name: str = "month_start") -> DataFrame:
    """One row per month start, from the month of first to that of last."""
    _check_length(first, last)
    months = F.sequence(F.lit(first.replace(day=1)), F.lit(last.replace(day=1)), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(months).alias(name))


def gap_fill(spine: DataFrame, df: DataFrame, on: str, fill: dict[str, object]) -> DataFrame:
    """Keep every spine row; measures missing from df get the given value."""
    joined = spine.join(df, on, "left")
    return joined.select(on, *[F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType)).alias(c)
                               for c, v in fill.items()])


def missing_days(calendar: DataFrame, day: str = "full_date", by: list[str] | None = None) -> DataFrame:
    """Days between a calendar's first and last day that it does not hold; with `by`, of each group's own calendar.

    Each day is compared with the next one of its group; only gaps, a row each, are spelt out as days. A group's rows meet in one
    task: they are its distinct days, or nearly. Null days are left out, a null group is a group.
    """
    by = by or []
    after = F.lead(day).over(Window.partitionBy(*by).orderBy(day))
    gaps = calendar.where(F.col(day).isNotNull()).select(*by, F.date_add(day, 1).alias("_first"), F.date_sub(after, 1).alias("_last")).where("_first <= _last")
    return gaps.select(*by, F.explode(F.sequence("_first", "_last", F.expr("INTERVAL 1 DAY"))).alias("missing_date"))
