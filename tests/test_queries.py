"""Every registered query against its SQL."""

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in ORACLE:
        assert difference(got, duck.execute(ORACLE[name]).df()) is None
