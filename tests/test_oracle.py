"""Every registered query equals its SQL twin: values, column names and types."""

from __future__ import annotations

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from starloom.workload.oracle import SQL
from starloom.workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_twin(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SMALL) == []


def test_comparison_notices_a_cent(spark, con):
    sql = entry.oracle_sql()["l1_total_revenue"].replace("coalesce(sum(sales_amount), 0)", "sum(sales_amount) + 0.01")
    assert compare(spark, con, "l1", entry.queries()["l1_total_revenue"], sql, SMALL)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 81
