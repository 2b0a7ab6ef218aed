import random
from hashlib import sha256

import pytest

from quartergrid.llm import common, line_dedup
from quartergrid.llm.line_dedup import dedup_lines, one_edit

from .cases import awkward, by_id, docs, prose


def brute(texts, least=5):
    seen, out = [], {}
    for doc_id, t in sorted(texts):
        kept = []
        for line in t.split("\n"):
            w = [x.encode() for x in line.lower().split()]
            again = len(w) >= least and any(
                w == s or (min(len(w), len(s)) >= 8 and one_edit(w, s)) for s in seen)
            if len(w) >= least:
                seen.append(w)
            if not again:
                kept.append(line)
        out[doc_id] = "\n".join(kept)
    return out


def test_lines_of_any_length(spark):
    texts = [(1, "注意事项\nplain words of the first one here\n\nok"), (2, "注意事项\nok\n\nanother line that is long enough now"), (3, "OK\n \n\t")]
    got = {r["doc_id"]: r["kept_text"] for r in dedup_lines(docs(spark, texts), 1).collect()}
    assert got == brute(texts, 1)
    assert got[2] == "\nanother line that is long enough now" and got[3] == " \n\t"


def test_one_edit():
    a = b"a b c d".split()
    assert one_edit(a, a) and one_edit(a, b"a b c".split()) and one_edit(a, b"x b c d".split())
    assert one_edit(b"".split(), b"a".split()) and one_edit(a, b"a b x c d".split())
    assert not one_edit(a, b"a b".split()) and not one_edit(a, b"b a c d".split())
    assert not one_edit(a, b"b c d a".split())


def test_equals_brute_force(spark):
    rng = random.Random(3)
    stock = [prose(rng, rng.randrange(1, 14), 30) for _ in range(12)]
    texts = []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(stock))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = [f"e{rng.randrange(5)}"] * rng.randrange(2)
            lines.append(" ".join(line).title() if rng.random() < 0.1 else " ".join(line))
        texts.append((i, "\n".join(lines)))
    got = {k: v[0] for k, v in by_id(dedup_lines(docs(spark, texts))).items()}
    assert {k: v["kept_text"] for k, v in got.items()} == brute(texts)
    assert all(v["words"] == "x" and v["n"] == 7 for v in got.values())
    assert {k: v["n_lines"] for k, v in got.items()} == {k: t.count("\n") + 1 for k, t in texts}


def test_awkward_rows(spark):
    line = "one two three four five"
    got = by_id(dedup_lines(awkward(spark, f"{line}\n\n{line}")))
    assert got[1][0]["kept_text"] is None and got[1][0]["n_lines"] == 0
    assert got[2][0]["kept_text"] == "" and got[2][0]["n_lines"] == 1
    assert [r["kept_text"] for r in got[4]] == [f"{line}\n"] * 2
    assert got[5][0]["n_removed"] == 0
    assert sorted(r["n_removed"] for r in got[None]) == [0, 0]


def test_empty_table(spark):
    assert dedup_lines(docs(spark, [(1, "a")]).filter("false")).count() == 0


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_lines_alone_are_not_carried_on(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    rng = random.Random(8)
    base = [prose(rng, 20, 10**9) for _ in range(300)]
    texts = [(2 * i, " ".join(w)) for i, w in enumerate(base)]
    texts += [(2 * i + 1, " ".join([*w[:15], "edit", *w[16:]] if i % 10 == 0 else w[:15] + prose(rng, 5, 10**9)))
              for i, w in enumerate(base)]
    stored = {}

    def record(df, name):
        stored[name] = common.staged(df, name)
        return stored[name]

    monkeypatch.setattr(line_dedup, "staged", record)
    got = {r["doc_id"]: r["kept_text"] for r in dedup_lines(docs(spark, texts)).collect()}
    assert got == brute(texts)
    # All lines share a half; no deletion variant but those of the thirty pairs meets another.
    sizes = {k: v.count() for k, v in stored.items()}
    assert sizes.pop("lines") == 600 and sizes.pop("variants") == sizes.pop("sharing") * 20 == 12_000
    assert sizes.pop("met_variants") == 60
    assert sizes["repeated"] == 0 and sizes["goes"] == 30


@pytest.mark.parametrize("limit", [0, 64 << 20])
def test_texts_go_to_python_in_small_batches_only(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
    line = "one two three four five six seven eight"
    many = "\n".join(f"line number {i} of the many of one text" for i in range(20_000))
    texts = [(1, f"\n{line}\n\n"), (2, f"{line}\n\n{line}"), (3, line), (4, None), (5, ""), (6, many), (7, f"{many}\né stays"), (8, None)]
    name, held = "spark.sql.execution.arrow.maxRecordsPerBatch", {}

    def record(df, stage):
        held[stage] = int(spark.conf.get(name))
        return common.staged(df, stage)

    monkeypatch.setattr(line_dedup, "staged", record)
    before = spark.conf.get(name)
    out = dedup_lines(docs(spark, [*texts, (1, None)]))
    assert {"lines", "variants", "words", "near", "goes"} <= set(held) and max(held.values()) <= 1000
    assert spark.conf.get(name) == before
    # What runs later, in batches of any size, has no Python in it.
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "InArrow" not in plan and "Python" not in plan
    got = by_id(out.filter("n_removed >= 0"))
    assert {r["kept_text"] for r in got[1]} == {None, f"\n{line}\n\n"}
    # All lines of the long text but its first one are one edit from an earlier one.
    kept = {k: got[k][0]["kept_text"] for k in range(2, 9)}
    assert kept == {2: "", 3: "", 4: None, 5: "", 6: many.split("\n")[0], 7: "é stays", 8: None}
    counts = {k: (got[k][0]["n_lines"], got[k][0]["n_removed"]) for k in range(2, 9)}
    assert counts == {2: (3, 2), 3: (1, 1), 4: (0, 0), 5: (1, 0), 6: (20_000, 19_999), 7: (20_001, 20_000), 8: (0, 0)}
    assert got[4][0]["kept_sha256"] == got[3][0]["kept_sha256"] == sha256(b"").hexdigest()
    assert got[7][0]["kept_sha256"] == sha256("é stays".encode()).hexdigest()
