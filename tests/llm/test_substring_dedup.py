import random
from hashlib import sha256

import pytest

from quartergrid.llm.substring_dedup import difference_cover, remove_repeated_passages

from .cases import awkward, by_id, docs, prose


def brute(texts, size):
    first = {}
    for doc_id, t in texts:
        w = (t or "").split()
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, doc_id), doc_id)
    out = {}
    for doc_id, t in texts:
        w = (t or "").split()
        gone = {j for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < doc_id for j in range(i, i + size)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.setdefault(doc_id, []).append({
            "n_words": len(w), "n_removed": len(gone), "kept_sha256": sha256(kept.encode()).hexdigest(),
            "kept_text": kept})
    return out


@pytest.mark.parametrize("size,period", [(6, 3), (9, 7), (50, 31)])
def test_equals_brute_force(spark, size, period):
    rng = random.Random(size)
    shared = [prose(rng, rng.randrange(size - 1, 3 * size)) for _ in range(6)]
    texts = []
    for i in range(40):
        parts = [prose(rng, rng.randrange(0, size)) for _ in range(3)]
        parts += [rng.choice(shared)[rng.randrange(3):] for _ in range(2)]
        rng.shuffle(parts)
        texts.append((i * 3, " ".join(w for p in parts for w in p)))
    texts += [(200, texts[0][1]), (201, texts[0][1])]
    assert by_id(remove_repeated_passages(docs(spark, texts), size, period)) == brute(texts, size)


def test_covers_give_every_difference():
    for period in range(2, 32):
        cover = difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(difference_cover(31)) == 6


def test_awkward_rows(spark):
    sample = "a b c d e f"
    got = by_id(remove_repeated_passages(awkward(spark, sample), 3, 2))
    for k in (1, 2, 3):
        assert got[k][0]["n_words"] == 0 and got[k][0]["kept_text"] == ""
    assert [r["n_removed"] for r in got[4]] == [0, 0]  # a repeated row is the same document
    assert sorted(r["n_removed"] for r in got[None]) == [0, 0]
    assert got[5][0]["n_words"] == 60_000 and got[5][0]["n_removed"] == 0


def test_empty_table_and_bad_period(spark):
    assert remove_repeated_passages(docs(spark, [(1, "a")]).filter("false")).count() == 0
    with pytest.raises(ValueError):
        remove_repeated_passages(docs(spark, [(1, "a")]), 5, 6)
