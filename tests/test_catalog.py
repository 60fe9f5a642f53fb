"""Every registered query with an SQL twin, on the small tables."""

import os

import __spark_entry__ as contract
import oracle
import pytest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    mine = contract.queries()[name](spark, SMALL).toPandas()
    theirs = con.execute(contract.oracle_sql()[name]).fetchdf()
    assert oracle.difference(mine, theirs) is None


def test_entry_and_names(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
