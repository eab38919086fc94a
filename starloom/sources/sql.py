"""SQL access: parameterised queries and assertion suites."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def run_query(spark: SparkSession, sql: str, params: dict | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run a query with :name markers, bound as literals by Spark (never by text).

    The tables' names hold for this query alone: they are dropped once it is planned.
    """
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    try:
        return spark.sql(sql, args=params or {})
    finally:
        for name in tables or {}:
            spark.catalog.dropTempView(name)


@dataclass(frozen=True)
class SuiteResult:
    """Outcome of one suite; an errored suite counts as one failed test."""

    name: str
    tests: list[tuple[str, int]]
    error: str | None = None

    @property
    def failed(self) -> int:
        return 1 if self.error else sum(1 for _, rows in self.tests if rows > 0)


def run_suite(spark: SparkSession, name: str, sql_path: str | Path, tables: dict[str, DataFrame]) -> SuiteResult:
    """Run an SQL file that yields (test_name, failed_rows); a test passes with 0 failed rows."""
    try:
        text = Path(sql_path).read_text(encoding="utf-8").strip().rstrip(";")
        if not text:
            raise ValueError(f"empty SQL file: {sql_path}")
        rows = run_query(spark, text, tables=tables).select("test_name", "failed_rows").collect()
        return SuiteResult(name, [(r.test_name, int(r.failed_rows)) for r in rows])
    except Exception as exc:  # the suite is reported as failed, later suites still run
        return SuiteResult(name, [], str(exc))
