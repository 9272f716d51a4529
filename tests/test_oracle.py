"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from docops.plans.oracle import ORACLE
from docops.plans.registry import registered
from tests.compare import connect, spark_rows, sql_rows

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    df = entry_point.queries()[name](spark, DIRECTORY)
    assert spark_rows(df) == sql_rows(connection, ORACLE[name])


def test_every_query_has_sql():
    assert set(registered()) == set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 10 and len({r["total"] for r in rows}) == 1
