"""Every registered query against its SQL on DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from daybook.plans.star import QUERIES
from daybook.plans.star_sql import ORACLES
from tests.oracle_check import compare, connect

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, contract.queries()[name], contract.oracle_sql()[name], SF) == []


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[:2] == ["category", "order_date"]
    assert result.count() > 0
