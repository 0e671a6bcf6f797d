"""Every registered query against its SQL on the folder the driver checks."""

import pytest

from workloads import compare, registered

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registered.QUERIES) == set(registered.ORACLES)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_agrees_with_sql(spark, con, name):
    assert compare.compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["uf", "qty"]
    assert registered.QUERIES.keys() <= contract.queries().keys()
    assert registered.ORACLES.keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
