import os

import __spark_entry__ as contract
import pytest
from compare import assert_same
from tabularium.checks.oracles import ORACLES
from tabularium.checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_the_contract_has_them_all():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, name):
    rows = assert_same(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name])
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 1500
