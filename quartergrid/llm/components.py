"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartergrid.llm.common import staged


def _state(edges: DataFrame) -> tuple:
    """Number of edges and two sums over them: unchanged edges, unchanged state."""
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(mixed.cast("decimal(38,0)")), F.bit_xor(mixed),
    ).first())


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node ``u`` to the least of them and ``u``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    joined = pairs.join(least, "u")
    if larger_only:
        out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("low").alias("b"))
    else:
        each = joined.select(F.col("v").alias("a"), F.col("low").alias("b"))
        out = each.unionByName(least.select(F.col("u").alias("a"), F.col("low").alias("b")))
    return out.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the least node reachable over ``edges`` (a, b).

    Self-links and repeated links change nothing, a null end drops the link; an
    empty table gives an empty table. Nodes without a link are not listed. Each
    round replaces the links by stars around smaller nodes; stars are sums and
    joins on single nodes, so a node with many links is no group in one task.
    The number of rounds grows with the logarithm of the longest path.
    """
    held = staged(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a is not null and b is not null and a != b").distinct(), "links",
    )
    before = None
    while (now := _state(held)) != before:
        before = now
        both = held.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            held.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = _star(both, larger_only=True)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        held = staged(_star(down, larger_only=False), "links")
    rooted = held.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return rooted.unionByName(held.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
