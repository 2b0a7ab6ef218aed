import random
from collections import Counter

import numpy as np
import pytest

from quartergrid.llm import common, jaccard_join
from quartergrid.llm.components import components
from quartergrid.llm.jaccard_join import jaccard_classes

from .cases import awkward, by_id, docs, prose


def brute(texts, size, percent):
    sets = []
    for _, t in texts:
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(texts):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return {d: [{"n_shingles": len(sets[i]), "component_id": least[find(i)]}] for i, (d, _) in enumerate(texts)}


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (2, 50)])
def test_equals_brute_force(spark, size, percent):
    rng = random.Random(size)
    texts = []
    for _ in range(12):
        base = prose(rng, rng.randrange(3, 90))
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(copy).title() if rng.random() < 0.2 else "\n".join(copy))
    texts = list(enumerate(texts, start=10))
    assert by_id(jaccard_classes(docs(spark, texts), size, percent)) == brute(texts, size, percent)


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(5)
    base = prose(rng, 200, 10**6)
    texts = []
    for i in range(150):
        copy = list(base)
        copy[i] = f"edit{i}"
        texts.append(" ".join(copy))
    got = by_id(jaccard_classes(docs(spark, texts), 4, 85))
    assert {r["component_id"] for rows in got.values() for r in rows} == {0}


def test_awkward_rows(spark):
    got = by_id(jaccard_classes(awkward(spark, "one two three four five six"), 5, 80))
    assert got[1] == [{"n_shingles": 0, "component_id": 1}]
    assert got[2][0]["component_id"] == 2 and got[3][0]["component_id"] == 3
    assert got[4] == [{"n_shingles": 2, "component_id": 4}] * 2
    assert got[5][0]["n_shingles"] == 59_996
    assert got[6] == [{"n_shingles": 1, "component_id": 6}]
    assert sorted(map(str, got[None])) == sorted(map(str, [
        {"n_shingles": 2, "component_id": 4}, {"n_shingles": 0, "component_id": None}]))


def test_empty_table(spark):
    assert jaccard_classes(docs(spark, [(1, "a")]).filter("false")).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("kept,chunk", [(20, 50), (5, 7), (1000, 300), (1, 1)])
def test_frequent_shingles_are_held_with_bounded_error(monkeypatch, kept, chunk):
    monkeypatch.setattr(jaccard_join, "TASK_SHINGLES", kept)
    monkeypatch.setattr(jaccard_join, "CHUNK_SHINGLES", chunk)
    rng = np.random.default_rng(kept)
    seen, frequent = Counter(), jaccard_join.Frequent()
    for _ in range(60):
        one = np.unique(rng.zipf(1.3, 40).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        seen.update(one.tolist())
        frequent.add(one)
    frequent.fold()
    held = dict(zip(frequent.token.tolist(), frequent.hits.tolist()))
    assert len(held) <= kept
    slack = sum(seen.values()) / (kept + 1)
    for token, n in seen.items():
        assert n - slack <= held.get(token, 0) <= n
    empty = jaccard_join.Frequent()
    empty.fold()
    assert not len(empty.token)


def test_frequent_shingles_come_last_by_their_own_counts(spark, monkeypatch):
    common = " ".join(f"c{i}" for i in range(12))
    texts = [(i, f"{common} " + " ".join(f"w{i}x{j}" for j in range(8))) for i in range(60)]
    counted = jaccard_join.staged(jaccard_join.shingle_sets(docs(spark, texts), 5), "shingles")
    order = jaccard_join.rarity(counted)
    found = dict(jaccard_join._sets([t.encode() for _, t in texts], 5))
    shared = np.intersect1d(found[0], found[1])
    own = np.setdiff1d(found[0], shared)
    assert len(shared) == 8 and order.of(shared).min() > order.of(own).max()
    assert set(shared.tolist()) == set(order.token.tolist())
    entries = jaccard_join.prefix_entries(docs(spark, texts), 5, 80, order)
    assert entries.groupBy("token").count().filter("count > 1").count() == 0
    monkeypatch.setattr(jaccard_join, "FREQUENT_SHINGLES", 3)  # more of one count than may be held: none is
    assert not len(jaccard_join.rarity(counted).token)


def test_copies_count_once_per_task(spark):
    text = " ".join(f"w{i}" for i in range(30))
    counted = jaccard_join.staged(jaccard_join.shingle_sets(docs(spark, [text] * 500).coalesce(1), 5), "shingles")
    assert counted.filter("token is not null").groupBy().max("hits").first()[0] == 1
    entries = jaccard_join.prefix_entries(docs(spark, [text] * 500).coalesce(1), 5, 80, jaccard_join.rarity(counted))
    assert entries.count() == 26 - 21 + 1


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_shingles_of_one_set_are_not_carried_on(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(9)
    texts = []
    for i in range(60):
        base = prose(rng, 60, 10**9)
        texts.append((3 * i, " ".join(base)))
        if i % 6 == 0:
            texts.append((3 * i + 1, " ".join([*base[:30], "edit", *base[31:]])))
            texts.append((3 * i + 2, " ".join(base)))
    stored = {}

    def record(df, name):
        stored[name] = common.staged(df, name)
        return stored[name]

    monkeypatch.setattr(jaccard_join, "staged", record)
    assert by_id(jaccard_classes(docs(spark, texts), 5, 80)) == brute(texts, 5, 80)
    entries = stored["prefixes"].dropDuplicates(["token", "set_key"])
    shared = entries.groupBy("token").count().filter("count > 1")
    assert shared.select("token").subtract(stored["met_twice"]).count() == 0
    assert stored["shared"].count() == shared.groupBy().sum("count").first()[0] < entries.count() / 4
    assert stored["ends"].count() == 0  # of the last pairs; those of hubs come before
