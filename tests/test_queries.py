"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from harness.compare import difference, oracle_connection
from harness.oracles import ORACLES
from harness.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, con, SF, name) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
