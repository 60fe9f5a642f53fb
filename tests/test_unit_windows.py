"""Sequence windows per unit have the method's length."""

import os

import __spark_entry__ as contract
import pytest
from gaugeline.operators import prep

SMALL = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are not here")


def test_windows_by_unit_take_thirty_steps(spark):
    got = contract.queries()["sequence_windows_by_unit"](spark, SMALL).agg({"pos": "min", "unit_id": "count"}).first()
    assert got["count(unit_id)"] > 0 and got["min(pos)"] == prep.SEQUENCE_LENGTH == 30
