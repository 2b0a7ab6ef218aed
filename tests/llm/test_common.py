import pytest

from quartergrid.llm import common
from quartergrid.llm.common import flagged, matching, missing

from ..conftest import rows


def tables(spark):
    left = [(i % 700 if i % 9 else None, i % 5, f"t{i}") for i in range(2000)]
    right = [(i, i % 5, f"u{i}") for i in range(0, 3000, 7)] + [(None, 1, "u")]
    return (spark.createDataFrame(left, "k long, m int, t string").repartition(3),
            spark.createDataFrame(right, "k long, m int, u string").repartition(2))


@pytest.mark.parametrize("limit", [0, 64 << 20])
@pytest.mark.parametrize("bits", [1 << 15, 1 << 28])
def test_joins_equal_those_of_spark(spark, monkeypatch, limit, bits):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(common, "BITMAP_BITS", bits)
    monkeypatch.setattr(common, "BITS_PER_KEY", 1 << 8)
    left, right = tables(spark)
    by_k = right.select("k", "u")
    assert rows(matching(left, by_k, "k")) == rows(left.join(by_k, "k"))
    assert rows(matching(left, right, ["k", "m"])) == rows(left.join(right, ["k", "m"]))
    assert rows(matching(left, by_k, "k", "left_semi")) == rows(left.join(by_k, "k", "left_semi"))
    assert rows(missing(left, by_k, "k")) == rows(left.join(by_k, "k", "left_anti"))
    assert missing(left, by_k, "k").columns == left.columns
    none = by_k.filter("false")
    assert matching(left, none, "k").count() == 0 and missing(left, none, "k").count() == 2000


def test_few_others_are_flagged(spark):
    keys = spark.range(0, 4000, 2).withColumnRenamed("id", "k")
    got = flagged(spark.range(4000).withColumnRenamed("id", "k"), keys, ["k"], "in")
    assert got.columns == ["k", "in"] and got.filter("k % 2 = 0 and not in").count() == 0
    assert got.filter("in").count() < 2200
