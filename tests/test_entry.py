"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracles import ORACLES
from checks.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_of_the_library_has_sql():
    assert set(REGISTRY) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    result = compare(spark, con, SF, name)
    assert result["match"], result
    assert result["rows"] > 0 and not result["cross_join"]
