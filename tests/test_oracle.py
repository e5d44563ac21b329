"""Every registered query against its SQL."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# The corpus operators, where they are present, have their own tests.
QUERIES = {n: q for n, q in entry.queries().items() if q.__module__ != "tallyforge.llm.queries"}


@pytest.fixture(scope="module")
def con():
    return check_oracle.oracle(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in SQL
    assert check_oracle.compare(spark, con, SF_DIR, name, QUERIES[name], SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() == 1
