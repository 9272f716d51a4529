"""The registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from docops.llm import registry
from tests.compare import connect, spark_rows, sql_rows

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    df = registry.QUERIES[name](spark, DIRECTORY)
    assert spark_rows(df) == sql_rows(connect(DIRECTORY), registry.SQL[name])


def test_all_are_registered():
    names = entry_point.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
