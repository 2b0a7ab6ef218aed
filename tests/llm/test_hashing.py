import random

import numpy as np
import pytest

from quartergrid.llm import hashing
from quartergrid.llm.hashing import Words, mix, ranges, sums

BLOCK = 1 << hashing.PLACE_BITS


@pytest.mark.parametrize("size", [0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK - 1, 2 * BLOCK, 3 * BLOCK + 7])
def test_ranges_by_whole_numbers(size):
    """Equal to sums of value * base ** place, whatever the place and the block."""
    rng = random.Random(size)
    values = np.array([rng.getrandbits(64) for _ in range(size)], np.uint64)
    table, base = sums(values, 2), hashing._odd(2)
    edges = [e for e in (0, 1, BLOCK - 2, BLOCK - 1, BLOCK, BLOCK + 1, 2 * BLOCK - 1, 2 * BLOCK, size - 1, size) if 0 <= e <= size]
    for start in edges:
        for end in edges:
            if 0 <= end - start < 9 or (start, end) == (0, size):
                raw = sum(int(v) * pow(base, k, 1 << 64) for k, v in enumerate(values[start:end])) + end - start
                want = mix(np.array([raw % (1 << 64)], np.uint64))
                assert ranges(table, np.array([start]), np.array([end])) == want


def test_words_hash_alike_wherever_they_stand():
    words = Words([b"alpha " * 40_000 + b"beta", b"beta alpha"])
    assert len(set(words.hash.tolist())) == 2 and words.hash[40_000] == words.hash[40_001]
    assert words.first.tolist() == [0, 40_001, 40_003]


def test_tables_are_broadcast_by_bytes(spark):
    from quartergrid.llm.common import bytes_in_memory, of_checked_size

    few = spark.range(100)
    assert bytes_in_memory(few) == 4000 and bytes_in_memory(few.filter("false")) == 0
    wide = few.selectExpr("id", "repeat('x', 1000) as s", "array(id, id) as a", "cast(null as string) as n")
    assert 100_000 < bytes_in_memory(wide) < 120_000
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(of_checked_size(wide)) and not hinted(of_checked_size(wide, 10_000))
