"""Stage runner: ingest, model, audit; any stage can be left out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Row, SparkSession

from starloom.operators.durable import shuffles_removed
from starloom.plans import audit
from starloom.plans.clean import clean_views
from starloom.plans.publish import publish, read_star
from starloom.plans.star import Calendar
from starloom.sources.extracts import read_extracts, read_staging, write_staging

STAGES = ("staging", "warehouse", "validation")


@dataclass
class RunReport:
    """What each stage did; `checks` holds the 72 result rows."""

    staged_rows: dict[str, int] = field(default_factory=dict)
    version: str | None = None
    checks: list[Row] = field(default_factory=list)
    reports: list[str] = field(default_factory=list)

    @property
    def critical_failures(self) -> int:
        return sum(1 for c in self.checks if c.status == "FAIL")

    @property
    def warnings(self) -> int:
        return sum(1 for c in self.checks if c.status == "WARNING")

    @property
    def passed(self) -> int:
        return sum(1 for c in self.checks if c.status == "PASS")


def run(spark: SparkSession, source: str, home: str, stages: tuple[str, ...] = STAGES, calendar: Calendar = Calendar()) -> RunReport:
    """Run the wanted stages in order; a failing stage raises and stops the run.

    source: folder of CSV extracts. home: folder for staging, warehouse and validation_reports.
    """
    home, report = home.rstrip("/"), RunReport()
    if "staging" in stages:
        report.staged_rows = write_staging(spark, read_extracts(spark, source), f"{home}/staging")
    if "warehouse" in stages:
        raw = read_staging(spark, f"{home}/staging")
        report.version = publish(spark, clean_views(raw), f"{home}/warehouse", audit.prepublish_gate(raw), calendar)
    if "validation" in stages:
        star = read_star(spark, f"{home}/warehouse")
        with shuffles_removed(spark):
            report.checks = audit.check_results(star).orderBy("check_no").collect()
            failed = {c.name for c in report.checks if c.failed_count > 0}
            report.reports = audit.write_reports(star, failed, f"{home}/validation_reports")
    return report
