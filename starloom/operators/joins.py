"""Lookups between facts and dimensions.

No side is broadcast by hint unless its size is fixed by construction. Catalyst and AQE broadcast a
side when its measured size is under spark.sql.autoBroadcastJoinThreshold, else sort-merge with AQE
skew splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_via(fact: DataFrame, key: str, partials: dict[str, Column], dim: DataFrame, attrs: list[str],
               how: str = "inner") -> DataFrame:
    """Aggregate a fact by its foreign key, then attach dimension attributes to the small result.

    The fact is combined on the map side before any shuffle, so a key that holds a third of the rows
    sends one row per task, and the join runs on one row per key. The caller re-aggregates by attrs.
    """
    grouped = fact.groupBy(key).agg(*[expr.alias(name) for name, expr in partials.items()])
    return grouped.join(dim.select(key, *attrs), key, how)


def key_counts(table: DataFrame, columns: dict[str, tuple[str, str | None]], dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per labelled key column, in a single scan: present and NULL rows, distinct values, and rows whose value has no dimension row.

    `columns` maps a label to (column, dimension or None), `dims` a dimension to its table and key. All columns become
    (column's place, value) counts, of whole numbers alone and combined map-side; only distinct values are joined. A label is
    returned even when it has no row.
    """
    cells = ", ".join(f"{place}, CAST({column} AS BIGINT)" for place, (column, _) in enumerate(columns.values(), start=1))
    cells = table.selectExpr(f"stack({len(columns)}, {cells}) AS (place, value)")
    dim_of = F.array(*[F.lit(dim or "") for _, dim in columns.values()])
    counts = cells.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).withColumn("dim", F.element_at(dim_of, F.col("place")))
    matched = F.lit(True)
    if dims:
        keys = None
        for name, (dim, pk) in dims.items():
            part = dim.select(F.lit(name).alias("k_dim"), F.col(pk).cast("bigint").alias("k_value")).distinct()
            keys = part if keys is None else keys.unionByName(part)
        counts = counts.join(keys, (F.col("value") == F.col("k_value")) & (F.col("dim") == F.col("k_dim")), "left")
        matched = F.col("k_value").isNotNull() | (F.col("dim") == "")  # a column without a dimension has no orphans
    present = F.col("value").isNotNull()
    totals = counts.groupBy("place").agg(
        F.sum(F.when(present, F.col("n"))).alias("present"), F.sum(F.when(~present, F.col("n"))).alias("nulls"),
        F.count("value").alias("distinct_values"), F.sum(F.when(present & ~matched, F.col("n"))).alias("orphans"))
    labels = table.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(label) for label in columns])).alias("before", "label"))
    zero = F.lit(0).cast("bigint")
    return labels.join(totals, F.col("before") + 1 == F.col("place"), "left").select("label", *[F.coalesce(c, zero).alias(c) for c in ("present", "nulls", "distinct_values", "orphans")])


def integer_counts(table: DataFrame, column: str) -> DataFrame:
    """One row for an integer column: present, nulls, distinct_values.

    Distinct values are the bits of bitmaps, one of 4 kB for each 32,768 consecutive integers, made in each task and merged, so no row is
    exchanged for a value. This suits keys that are dense and stored in runs, as surrogate keys are: a task's bitmaps cover its own runs.
    """
    value = F.col(column).cast("bigint")
    maps = table.groupBy(F.bitmap_bucket_number(value).alias("bucket")).agg(
        F.count(value).alias("n"), F.count_if(value.isNull()).alias("nulls"), F.bitmap_construct_agg(F.bitmap_bit_position(F.coalesce(value, F.lit(1)))).alias("bits"))
    values = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bits"))
    return maps.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for c, name in (
        (F.col("n"), "present"), (F.col("nulls"), "nulls"), (values, "distinct_values"))])


def orphan_rows(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Fact rows whose foreign key is set but absent from the dimension."""
    keys = dim.select(F.col(pk).alias("_pk"))
    return fact.filter(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def share_of_total(df: DataFrame, value: str, name: str, digits: int = 2) -> DataFrame:
    """Add value as a percentage of the column total (a scalar subquery, no join and no window)."""
    from starloom.functions import pct

    total = df.agg(F.sum(value).alias("_total")).scalar()
    return df.withColumn(name, pct(value, total, digits))
