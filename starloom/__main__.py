"""Command line: spark-submit or python -m starloom <source> <home> [--skip-staging] ...

Exit codes: 0 all critical checks passed, 1 a critical check or the pre-publish audit failed, 2 an error.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
import traceback

from starloom.plans.publish import AuditFailed
from starloom.plans.run import STAGES, RunReport, run
from starloom.plans.star import Calendar
from starloom.session import session


def summary(report: RunReport) -> str:
    lines = [f"{t}: {n:,} rows" for t, n in report.staged_rows.items()]
    if report.version:
        lines.append(f"published {report.version}")
    for c in report.checks:
        lines.append(f"{c.check_no:>3} {c.category:<18} {c.name:<60} {c.total_evaluated:>12,} {c.failed_count:>10,} {c.error_pct:>7.2f}% {c.status}")
    if report.checks:
        lines.append(f"{len(report.checks)} checks, {report.passed} passed, {report.warnings} warnings, {report.critical_failures} critical failures")
    return "\n".join(lines)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starloom")
    parser.add_argument("source", help="folder of CSV extracts")
    parser.add_argument("home", help="folder for staging, warehouse and reports")
    for end in ("first", "last"):
        parser.add_argument(f"--{end}-day", type=dt.date.fromisoformat, help=f"{end} day of the calendar (YYYY-MM-DD); from the orders if not given")
    for stage in STAGES:
        parser.add_argument(f"--skip-{stage}", action="store_true")
    args = parser.parse_args(argv)
    stages = tuple(s for s in STAGES if not getattr(args, f"skip_{s}"))
    try:
        report = run(session(), args.source, args.home, stages, Calendar(args.first_day, args.last_day))
    except AuditFailed as exc:
        print("not published:", *exc.problems, sep="\n  ", file=sys.stderr)
        return 1
    except Exception:
        traceback.print_exc()
        return 2
    print(summary(report))
    return 1 if report.critical_failures else 0


if __name__ == "__main__":
    sys.exit(main())
