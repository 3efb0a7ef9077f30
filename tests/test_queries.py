"""Every registered query runs on the smallest data; those with SQL must equal it row for row."""

import pytest

import __spark_entry__ as entry_point
from tests.compare import compare, reference_connection

SF = "/root/testdata/sf0.001"
PLANS, SQLS = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return reference_connection(SF)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, con, name):
    problem, rows, _ = compare(spark, con, SF, PLANS[name], SQLS.get(name))
    assert problem == ""
    assert rows > 0 or name in SQLS


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["city", "year", "mean_kwh", "n_rows", "last_year_mean_kwh"]
    assert result.count() > 0
