import random
import re
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from quartergrid.llm import structure_repair as sr
from quartergrid.llm.structure_repair import Edits, Repair, audits, damaged, read_rows, repair_conversations, repaired

TURNS = "conv_id long, turn long, role string, text string, n int, draw long, kind string"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def by_brute_force(rows, inserts=3):
    """Cheapest legal edits of a few rows: every edit of every row, every insertion."""
    best = None
    for edits in product(*(["D"] if fault == sr.DELETED else ["D", "K", "Ru", "Ra"] for _, fault in rows)):
        for added in product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
            if sum(map(len, added)) > inserts:
                continue
            cost, out, audit = 0, "", ""
            for k, letters in enumerate(added):
                if k:
                    edit, (initial, fault) = edits[k - 1], rows[k - 1]
                    audit += edit[0]
                    cost += {"D": 4, "K": 0, "R": 3}[edit[0]] + 3 * (fault == sr.CUT_SHORT and edit != "D")
                    out += "" if edit == "D" else (initial or "?") if edit == "K" else edit[1]
                out, audit, cost = out + letters, audit + "I" * len(letters), cost + 3 * len(letters)
            if LEGAL.match(out):
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_cheapest_repair_by_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", ""]), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randrange(4))]
        repair = Repair()
        repair.feed(rows)
        assert repair.cheapest() == by_brute_force(rows), rows


def by_strings(rows):
    """The same programme with whole strings."""
    inf = {}

    def inserts(ends):
        for end in (sr.NOTHING, sr.SYSTEM, sr.ASSISTANT, sr.USER):
            if end in ends:
                c, s = ends[end]
                to = sr.TURN[end]
                ends[to] = min(ends.get(to, (c + 3, s + "I")), (c + 3, s + "I"))
        return ends

    best = inserts({sr.NOTHING: (0, "")})
    for initial, fault in rows:
        after = dict(inf)
        for end, (c, s) in best.items():
            tries = [(end, c + 4, s + "D")]
            if fault != sr.DELETED:
                more = c + 3 * (fault == sr.CUT_SHORT)
                tries.append((sr.TURN[end], more + 3, s + "R"))
                if (end, initial) in sr.KEPT:
                    tries.append((sr.KEPT[end, initial], more, s + "K"))
            for to, cost, text in tries:
                after[to] = min(after.get(to, (cost, text)), (cost, text))
        best = inserts(after)
    return min(best[end] for end in (sr.NOTHING, sr.ASSISTANT) if end in best)


@pytest.mark.parametrize("nodes", [16, 64, 1 << 14])
def test_long_conversations_settle_without_change(nodes, monkeypatch):
    monkeypatch.setattr(sr, "SETTLE_NODES", nodes)
    rng = random.Random(nodes)
    for size in (1, 7, 60, 300):
        for letters in (["u"], ["a", ""], ["s", "u", "a"], ["u", "a", "a"]):
            rows = [(rng.choice(letters), rng.choice([0, 0, 1, 2])) for _ in range(size)]
            repair = Repair()
            repair.feed(rows)
            assert repair.cheapest() == by_strings(rows)


def test_a_very_long_conversation_keeps_few_edits():
    rng = random.Random(5)
    repair = Repair()
    for _ in range(50):
        repair.feed([(rng.choice("sua"), rng.choice([0, 0, 1, 2])) for _ in range(1000)])
        assert len(repair.edits.edit) < 2 * sr.SETTLE_NODES
    assert len(repair.cheapest()[1].replace("I", "")) == 50_000


def test_comparison_of_shared_edits_and_collisions(monkeypatch):
    for modulus in (Edits.MODULUS, 2):  # the second makes most hashes collide
        monkeypatch.setattr(Edits, "MODULUS", modulus)
        rng, edits, spelt = random.Random(6), Edits(), [""]
        for _ in range(400):
            parent = rng.randrange(max(0, len(spelt) - 20), len(spelt))
            letter = rng.choice("DIKR")
            edits.add(parent, letter)
            spelt.append(spelt[parent] + letter)
        for _ in range(3000):
            x, y = rng.randrange(len(spelt)), rng.randrange(len(spelt))
            assert edits.less(x, y) == (spelt[x] < spelt[y])
        assert [edits.spelt(n) for n in range(len(spelt))] == spelt


def plain(rows):
    """The contract, row by row, for (conv_id, turn, role, text)."""
    out = {}
    for c, t, r, x in sorted(rows, key=lambda z: (z[1] is not None, z[1] or 0, z[2] or " ")):
        kept = out.setdefault(c, [])
        text, role = " " if x is None else x, " " if r is None else r
        draw = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        kept += [(t, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    result = {}
    for c, kept in out.items():
        n = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        codes, seen = [], set()
        for _, role, text in kept:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            codes.append((role[:1], {None: 0, "truncated": 2}.get(fault, 1)))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit = by_strings(codes)
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
        total, rest, lines = len(audit) - audit.count("D"), iter(kept), []
        for edit in audit:
            own = "user" if len(lines) % 2 == total % 2 else "assistant"
            if edit == "I":
                lines.append(f"{own}:")
                continue
            _, role, text = next(rest)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else own}:{text}")
        result[c] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **n, "illegal": illegal, "cost": cost,
            "audit": audit, "repaired_sha256": sha256("\n".join(lines).encode()).hexdigest()}
    return result


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], TURNS).repartition(3)


def test_rows_as_the_contract_reads(spark):
    rng = random.Random(7)
    words = ["a.", "b", "", "  \t", "c?", "D!\n", "e. x", None, "f.\x0b "]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "user"]), f"{rng.choice(words) or ''}{rng.choice(['', '.'])}"
             if rng.random() < 0.9 else None) for c in range(150) for t in sorted(rng.sample(range(40), rng.randrange(1, 9)))]
    rows += [(900, None, "user", "a."), (900, 5, "user", "b."), (901, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y.")]
    rows += [(902, t, ("user", "assistant")[t % 2], f"long {t}.") for t in range(3000)]
    got = {r["conv_id"]: r.asDict() for r in repair_conversations(damaged(read_rows(conversations(spark, rows)))).collect()}
    assert len(got) == 154
    want = plain(rows)
    for c, row in got.items():
        row.pop("conv_id")
        assert row == want[c], c


def test_rows_that_are_not_damaged_and_their_texts(spark):
    rows = [(1, 1, "system", "s."), (1, 2, "user", "u."), (1, 3, "assistant", "a."), (2, 0, "assistant", "a."), (2, 0, "assistant", "a."), (3, 0, None, None)]
    source = read_rows(conversations(spark, rows))
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in repair_conversations(source).collect()}
    assert got == {1: (0, "KKK"), 2: (7, "IKD"), 3: (4, "D")}
    texts = sorted((r["conv_id"], r["place"], r["role"], r["text"]) for r in repaired(source, audits(source)).collect())
    assert texts == [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "user", ""), (2, 1, "assistant", "a.")]
    assert repair_conversations(source.filter("false")).count() == 0


def test_conversation_that_damage_drops_whole(spark):
    gone = next(c for c in range(1000) if crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = repair_conversations(damaged(read_rows(conversations(spark, [(gone, 0, "user", "a.")])))).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
