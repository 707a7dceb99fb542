"""Every query with a SQL twin returns the same rows as the twin; the others return rows."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from checks.compare import compare

STATEMENTS = driver.oracle_sql()
QUERIES = driver.queries()


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_same_rows(spark, sf_dir, name):
    assert compare(spark, sf_dir, QUERIES[name], STATEMENTS[name]) == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0
