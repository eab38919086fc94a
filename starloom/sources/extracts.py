"""Raw CSV extracts to all-text staging tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.jobs import together
from starloom.operators.durable import shuffles_removed
from starloom.schemas import RAW_COLUMNS, raw_schema
from starloom.sources import files
from starloom.sources.records import records
from starloom.sources.versions import current_version, mark_live, new_version
from starloom.tables import LazyTables

log = logging.getLogger(__name__)

# File name patterns of the nine extracts; the leading word of a name is free.
FILE_PATTERNS: dict[str, str] = {
    "customers": "*customers_dataset.csv",
    "geolocation": "*geolocation_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "order_payments": "*order_payments_dataset.csv",
    "order_reviews": "*order_reviews_dataset.csv",
    "orders": "*orders_dataset.csv",
    "products": "*products_dataset.csv",
    "sellers": "*sellers_dataset.csv",
    "product_category_name_translation": "*product_category_name_translation.csv",
}

# Only free review text holds line breaks inside quotes.
MULTILINE = {"order_reviews"}


def read_extract(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Scan one extract by position: header skipped, every column text, malformed rows raise.

    A file whose values hold line breaks is read by as many tasks as any other; see records().
    """
    options = {"quote": '"', "escape": '"', "mode": "FAILFAST"}
    if table in MULTILINE:
        schema = ", ".join(f"{c} string" for c in RAW_COLUMNS[table])
        row = F.from_csv("record", schema, {**options, "multiLine": "true"})
        return records(spark, path).select(row.alias("row")).select("row.*")
    return spark.read.schema(raw_schema(table)).options(header=True, enforceSchema=True, encoding="UTF-8", **options).csv(path)


def read_extracts(spark: SparkSession, folder: str, patterns: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All nine raw tables of a folder; a table without a file is empty, with a warning."""
    # CSV column pruning would let a short or long row pass unseen.
    spark.conf.set("spark.sql.csv.parser.columnPruning.enabled", "false")
    raw = {}
    for table in RAW_COLUMNS:
        pattern = f"{folder.rstrip('/')}/{(patterns or FILE_PATTERNS)[table]}"
        if files.glob(spark, pattern):
            raw[table] = read_extract(spark, table, pattern)
        else:
            log.warning("no file for %s (%s): the table stays empty", table, pattern)
            raw[table] = spark.createDataFrame([], raw_schema(table))
    return raw


def write_staging(spark: SparkSession, raw: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Full refresh of the staging tables, live only when all of them are written.

    Row counts are observed while writing, so nothing is scanned twice.
    """
    version = new_version(folder)

    def write(table: str, df: DataFrame) -> int:
        seen = Observation(table)
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{version}/{table}")
        return seen.get["rows"]

    with shuffles_removed(spark):
        counts = together(*[partial(write, table, df) for table, df in raw.items()])
    mark_live(spark, version)
    return dict(zip(raw, counts))


def read_staging(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """The live staging tables."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no staging tables under {folder}")
    return LazyTables({t: partial(spark.read.schema(raw_schema(t)).parquet, f"{version}/{t}") for t in RAW_COLUMNS})
