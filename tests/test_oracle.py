"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks.compare import connect, difference
from checks.registry import ORACLES, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert len(want) > 0
    assert difference(got, want) is None
