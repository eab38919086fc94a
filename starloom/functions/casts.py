"""Text to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column | str) -> Column:
    """Empty string becomes NULL; anything else is kept."""
    return F.nullif(F.col(col) if isinstance(col, str) else col, F.lit(""))


def typed(col: Column | str, spark_type: str) -> Column:
    """Strict cast: NULL for empty text, an error (ANSI mode) for text that does not parse."""
    return blank_to_null(col).cast(spark_type)


def not_blank(col: Column | str) -> Column:
    """True when the value is neither NULL nor only spaces."""
    return F.length(F.trim(col)) > 0
