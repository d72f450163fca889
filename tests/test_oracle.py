"""Every query with SQL gives the same rows as DuckDB."""

import pytest
from oracle import compare, connect

from tallyloom.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    assert compare(got, duck.execute(ORACLES[name]).df()) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
