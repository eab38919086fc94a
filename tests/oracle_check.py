"""Compare registered queries with their SQL twins on one data folder.

Run as a script: python tests/oracle_check.py <folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def spark_rows(df) -> tuple[list[str], list[tuple[str, ...]]]:
    names = sorted(df.columns)
    return names, sorted(tuple(normal(v) for v in row) for row in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], dict[str, str], list[tuple[str, ...]]]:
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    names = sorted(types)
    listed = ", ".join(f'"{n}"' for n in names)
    rows = con.execute(f"SELECT {listed} FROM ({sql})").fetchall()
    return names, types, sorted(tuple(normal(v) for v in row) for row in rows)


SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> list[str]:
    """Differences between both engines; empty when they agree."""
    df = query(spark, sf_dir)
    names, rows = spark_rows(df)
    duck_names, types, expected = duck_rows(con, sql)
    problems = []
    if names != duck_names:
        return [f"columns {names} != {duck_names}"]
    for field in df.schema.fields:
        if SAME_TYPE.get(field.dataType.simpleString()) != types[field.name]:
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} / {types[field.name]}")
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} != {len(expected)}")
    different = [(a, b) for a, b in zip(rows, expected) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {names}: {different[0][0]} / {different[0][1]}")
    return problems


def main() -> int:
    from starloom.session import session

    import __spark_entry__ as entry

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
                                              "spark.checkpoint.dir": tempfile.mkdtemp(prefix="starloom-check-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, twins, bad = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if (only and name not in only) or name not in twins:
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, query, twins[name], sf_dir)
        except Exception as exc:
            problems = [str(exc)[:700]]
        bad += bool(problems)
        print(f"{name:32s} {'ok' if not problems else problems} {time.time() - start:.2f}s", flush=True)
    print("failed", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
