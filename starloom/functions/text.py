"""Text labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(col: Column | str) -> Column:
    """Capitalise after every non-alphanumeric character (Spark's initcap only looks at spaces)."""
    col = F.col(col) if isinstance(col, str) else col
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.substring(t, 2, 1 << 30))), ""
    )


def place_label(city: Column | str, state: Column | str) -> Column:
    """'city (state)'; NULL when either part is NULL."""
    city = F.col(city) if isinstance(city, str) else city
    state = F.col(state) if isinstance(state, str) else state
    return F.concat(city, F.lit(" ("), state, F.lit(")"))
