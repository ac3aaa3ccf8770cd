"""Every registered query against its DuckDB twin at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_harness import compare, duck_connection


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF01)


@pytest.mark.parametrize("name", [n for n in E.queries() if n in E.oracle_sql()])
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, name, SF01)
    assert result.get("match"), result
