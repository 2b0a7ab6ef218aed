import random
import re
from hashlib import md5, sha256
from math import fmod
from zlib import crc32

import pytest

from quartergrid.llm import prefix_trie as pt
from quartergrid.llm.prefix_trie import numbered_turns, prefix_trie, with_lent_openings

TURNS = "conv_id long, turn long, role string, text string, node int, place long, path string"
NONE = sha256(b"").hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TURNS).repartition(3)


def ordered(rows):
    out = {}
    key = lambda z: (z[1] is not None, z[1] or 0, z[2] or "", md5((z[3] or "").encode()).hexdigest())
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(c, []).append((role or "", text or ""))
    return out


def lent(held):
    out = {}
    for c, own in held.items():
        h = crc32(str(c).encode()) % 4
        base = c - int(fmod(c, 20))  # the sign of % is that of c, as in SQL
        out[c] = own if c == base else held.get(base, [])[:h] + own[h:]
    return out


def by_brute_force(held):
    """(conv_id, depth) -> the other columns."""
    members = {}
    for c, turns in held.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, who in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * words
    out = {}
    for node, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if len(held[c]) == len(node))))
        out[min(who), len(node)] = (
            min(members[node[:-1]]) if node else None, len(who), children.get(node, 0), leaves[node], saved[node],
            sha256(ends.encode()).hexdigest())
    return out


def found(trie):
    return {(r["conv_id"], r["depth"]): (
        r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
        for r in trie.collect()}


def varied(rng):
    rows = []
    for c in range(60):  # many share beginnings of any length
        like = random.Random(c % 5)
        size = rng.choice([1, 2, 3, 9, 17, 40])
        for t in range(size):
            text = f"same {like.random()}" if t < rng.choice([2, 30]) else f"own  {rng.random()}\n x"
            rows.append((c, t, ("user", "assistant")[t % 2], text))
    return rows


@pytest.mark.parametrize("band, chunk, bits", [(16, 4096, 12), (2, 4, 1), (4, 16, 2)])
def test_trie_by_brute_force(spark, monkeypatch, band, chunk, bits):
    monkeypatch.setattr(pt, "BAND", band)
    monkeypatch.setattr(pt, "CHUNK", chunk)
    monkeypatch.setattr(pt, "BLOCK_BITS", bits)
    rows = varied(random.Random(band))
    assert found(prefix_trie(*numbered_turns(conversations(spark, rows)))) == by_brute_force(ordered(rows))


def test_lent_openings_and_awkward_rows(spark):
    rng = random.Random(9)
    rows = varied(rng)
    rows += [(100, None, None, None), (100, 1, "user", "a"), (101, 5, "user", "b"), (None, 1, "user", "no conversation")]
    rows += [(102, 1, "user", "tie one"), (102, 1, "user", "tie two"), (102, 1, "assistant", "tie"), (102, 1, "user", "tie two")]
    rows += [(c, 0, "user", "one turn") for c in range(141, 160)]  # no 140: some lose all they have
    rows += [(-7, 0, "user", "a"), (-7, 1, "assistant", "long " * 50_000), (2**40 + 1, 1, "", "")]
    held = ordered(rows)
    want = by_brute_force(lent(held))
    assert found(prefix_trie(*with_lent_openings(*numbered_turns(conversations(spark, rows))))) == want
    assert want[-7, 0][5] != NONE and len([c for c, turns in lent(held).items() if not turns]) > 2


def test_one_beginning_for_all(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    got = found(prefix_trie(*numbered_turns(conversations(spark, rows))))
    assert got == by_brute_force(ordered(rows)) and len(got) == 4


def test_one_long_conversation(spark):
    rows = [(7, t, "user", f"turn {t}") for t in range(700)]
    got = found(prefix_trie(*numbered_turns(conversations(spark, rows))))
    assert len(got) == 701 and set(v[3] for v in got.values()) == {1}


def test_empty_table(spark):
    assert prefix_trie(*with_lent_openings(*numbered_turns(conversations(spark, [(1, 1, "", "")]).filter("false")))).count() == 0
