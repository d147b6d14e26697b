"""Each registered query against its SQL equivalent, and the shape of the registry."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from conftest import DATA
from spendwatch.plans.oracles import ORACLES
from spendwatch.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    same, detail = compare(spark, duck, DATA, name)
    assert same, detail


def test_every_query_of_the_plans_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
