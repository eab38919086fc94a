"""Row choice per key, by aggregation.

A window with row_number() would sort every row of a hot key in one task. Here each choice is a
min or max over a struct, which Spark combines on the map side, so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _nulls_last(names: list[str]) -> list[Column]:
    """Struct fields that order ascending with NULLs last under min()."""
    fields = []
    for i, name in enumerate(names):
        fields += [F.isnull(name).alias(f"_null{i}"), F.col(name).alias(name)]
    return fields


def modal_row(df: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """Most frequent attribute combination per key; ties go to the smallest, NULLs last."""
    combos = df.groupBy(key, *attrs).agg(F.count(F.lit(1)).alias("_n"))
    ranked = F.struct((-F.col("_n")).alias("_rank"), *_nulls_last(attrs))
    best = combos.groupBy(key).agg(F.min(ranked).alias("_best"))
    return best.select(key, *[F.col(f"_best.{a}").alias(a) for a in attrs])


def latest_row(df: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """Row with the greatest order columns per key; a NULL order value counts as the latest."""
    fields = []
    for i, name in enumerate(order):
        fields += [F.isnull(name).alias(f"_null{i}"), F.col(name).alias(f"_by{i}")]
    kept = [F.col(name).alias(f"_keep{i}") for i, name in enumerate(keep)]
    best = df.groupBy(key).agg(F.max(F.struct(*fields, *kept)).alias("_best"))
    return best.select(key, *[F.col(f"_best._keep{i}").alias(name) for i, name in enumerate(keep)])


def duplicate_keys(df: DataFrame, keys: list[str], count_as: str = "occurrences") -> DataFrame:
    """Key values held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).filter(F.col(count_as) > 1)
