"""Registered queries against their SQL."""

import pytest

from checks.compare import connect, difference
from quartergrid.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE[name]).df()
    assert len(got) > 0
    for c in got.columns:  # a column of nulls has no type in pandas
        if got[c].isna().all():
            got[c], want[c] = got[c].astype(object), want[c].astype(object)
        elif got[c].isna().any() and got[c].dtype != object:  # whole numbers and nulls have two
            got[c], want[c] = got[c].astype("Int64"), want[c].astype("Int64")
    assert difference(got, want) is None
