"""Write-audit-publish: a star version becomes visible whole, and only after its audit."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions import month_of_key
from starloom.jobs import together
from starloom.operators.durable import shuffles_removed
from starloom.operators.keys import row_keys
from starloom.plans import star as builders
from starloom.plans.star import Calendar
from starloom.schemas import DIMENSIONS, DURATIONS, MONTH_PARTITION, STAR_TABLES, star_columns, star_schema
from starloom.sources import files
from starloom.sources.versions import current_version, mark_live, new_version

Audit = Callable[[dict[str, DataFrame]], list[str]]


class AuditFailed(RuntimeError):
    """The new version broke a pre-publish condition; the old version stays live."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


class Version(dict[str, DataFrame]):
    """The tables of a star that was just written, and what was counted on the way: `seen[table][name]`."""

    def __init__(self, tables: Mapping[str, DataFrame], seen: Mapping[str, Mapping[str, int]]):
        super().__init__(tables)
        self.seen = seen


#: Rows that the pre-publish conditions count, by table: counted while a table is written, so that no audit scans it for them.
WATCHED: dict[str, dict[str, str]] = {
    "fact_order_fulfillment": {"negative": " OR ".join(f"{hours} < 0" for hours in DURATIONS)},
}


def _watched(df: DataFrame, table: str) -> tuple[DataFrame, Observation]:
    """df with its row count and its WATCHED rows observed."""
    seen = Observation(table)
    wanted = {name: F.count_if(F.expr(condition)) for name, condition in WATCHED.get(table, {}).items()}
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *[c.alias(name) for name, c in wanted.items()]), seen


def write_dimension(df: DataFrame, path: str, table: str) -> dict[str, int]:
    """Write a dimension; what was counted on the way."""
    watched, seen = _watched(df, table)
    watched.write.mode("overwrite").parquet(path)
    return seen.get


def write_fact(df: DataFrame, date_key: str, key: str, path: str, table: str, scratch: str) -> dict[str, int]:
    """Number a fact's rows and write it by purchase month; what was counted on the way.

    The rebalance hint groups rows by month, and AQE splits a month that is too large for one task
    and packs small ones together. Rows are stored in that layout once and numbered from there in a narrow pass.
    """
    monthly = df.withColumn(MONTH_PARTITION, month_of_key(date_key)).hint("rebalance", MONTH_PARTITION)
    watched, seen = _watched(row_keys(monthly, key, key, scratch), table)
    watched.write.mode("overwrite").partitionBy(MONTH_PARTITION).parquet(path)
    return seen.get


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One table of a version; facts keep their month column for partition pruning."""
    schema = star_schema(table)
    if table not in DIMENSIONS:
        schema = schema.add(MONTH_PARTITION, T.IntegerType())
    return spark.read.schema(schema).parquet(f"{path}/{table}")


def read_version(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {table: read_table(spark, path, table) for table in STAR_TABLES}


def write_star(spark: SparkSession, views: Mapping[str, DataFrame], path: str, calendar: Calendar = Calendar()) -> Version:
    """Build all six tables into a version folder; what is needed on the way stands below it and is deleted as soon as it was read for the last time.

    Facts join the written dimensions, so the planner sees their true sizes. The item fact takes its
    customer and date from the order fact; the other dimensions are built beside the order fact.
    """
    scratch, seen = f"{path}/_scratch", {}

    def dimension(table: str, df: DataFrame) -> None:
        seen[table] = write_dimension(df, f"{path}/{table}", table)

    def fact(table: str, df: DataFrame, date_key: str, key: str) -> None:
        seen[table] = write_fact(df, date_key, key, f"{path}/{table}", table, f"{scratch}/{table}")
        files.delete(spark, f"{scratch}/{table}")

    (orders, days), *_ = together(
        lambda: builders.stored_orders(views["vw_orders"], calendar, f"{scratch}/orders"),
        lambda: dimension("dim_customer", builders.dim_customer(views["vw_customers"], f"{scratch}/dimensions")),
        lambda: dimension("dim_product", builders.dim_product(views["vw_products"], f"{scratch}/dimensions")),
        lambda: dimension("dim_seller", builders.dim_seller(views["vw_sellers"], f"{scratch}/dimensions")),
    )
    files.delete(spark, f"{scratch}/dimensions")
    together(
        lambda: dimension("dim_date", builders.dim_date(spark, days)),
        lambda: fact("fact_order_fulfillment", builders.fact_order_fulfillment(
            orders, views["vw_customers"], views["vw_order_payments_agg"], views["vw_order_reviews_latest"], read_table(spark, path, "dim_customer"), days,
        ), "order_purchase_date_key", "fulfillment_key"),
    )
    files.delete(spark, f"{scratch}/orders")
    stored = {table: read_table(spark, path, table) for table in ["fact_order_fulfillment", "dim_product", "dim_seller"]}
    order_facts = stored["fact_order_fulfillment"].select(*star_columns("fact_order_fulfillment"))
    fact("fact_sales", builders.fact_sales(views["vw_order_items"], order_facts, stored["dim_product"], stored["dim_seller"]), "date_key", "sales_key")
    files.delete(spark, scratch)
    return Version(read_version(spark, path), seen)


def publish(spark: SparkSession, views: Mapping[str, DataFrame], warehouse: str, audit: Audit, calendar: Calendar = Calendar()) -> str:
    """Write a new version, audit it, then mark it live. On failure nothing is marked and nothing stays; a failed audit raises AuditFailed."""
    version = new_version(warehouse)
    try:
        with shuffles_removed(spark):
            problems = audit(write_star(spark, views, version, calendar))
        if problems:
            raise AuditFailed(problems)
        mark_live(spark, version)
    except BaseException:
        files.delete(spark, version)
        raise
    return version


def read_star(spark: SparkSession, warehouse: str, register: bool = False) -> dict[str, DataFrame]:
    """The live star; register=True also makes its tables visible to SQL."""
    path = current_version(spark, warehouse)
    if path is None:
        raise FileNotFoundError(f"no published version under {warehouse}")
    star = read_version(spark, path)
    if register:
        for name, df in star.items():
            df.createOrReplaceTempView(name)
    return star


def register_database(spark: SparkSession, warehouse: str, database: str = "warehouse") -> None:
    """Make the live star visible as <database>.<table>, so SQL with qualified names runs as it is.

    The views name one version; call again after publishing to move them.
    """
    path = current_version(spark, warehouse)
    if path is None:
        raise FileNotFoundError(f"no published version under {warehouse}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse.rstrip('/')}/catalog'")
    for table in STAR_TABLES:
        columns = ", ".join(star_columns(table))
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {columns} FROM parquet.`{path}/{table}`")


def version_rows(star: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [df.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for t, df in star.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out
