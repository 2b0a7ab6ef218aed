import random
import re
from hashlib import sha256

from quartergrid.llm.decontamination import contamination

from .cases import awkward, by_id, docs, prose


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(texts, items, window=10):
    out = {}
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for item_id, item in items:
            v = words(item)
            if not v or item_id is None:
                continue
            k = min(window, len(v))
            wanted = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)}
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in wanted:
                    hit |= set(range(i, i + k))
                    found.add(str(item_id))
        out.setdefault(doc_id, []).append({
            "n_words": len(w), "n_hit": len(hit), "n_items": len(found),
            "items_sha256": sha256(",".join(sorted(found)).encode()).hexdigest(),
            "contaminated": bool(hit), "item_ids": sorted(found)})
    return out


def items_table(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n int")


def test_equals_brute_force(spark):
    rng = random.Random(6)
    items = [(i, " ".join(prose(rng, n, 60))) for i, n in enumerate([1, 2, 3, 9, 10, 11, 25, 30, 12])]
    items += [(3, items[3][1]), (None, "w1 w2"), (50, None), (51, "!? -"), (52, "É ß zwei drei")]
    texts = []
    for i in range(50):
        part = words(rng.choice(items)[1])
        at = rng.randrange(len(part)) if part else 0
        mid = part[at : at + rng.randrange(1, 14)]
        texts.append((i, ", ".join(prose(rng, rng.randrange(9)) + mid + prose(rng, rng.randrange(9))).upper()))
    texts += [(60, "x É\x00ß--zwei DREI"), (61, "é ß zwei drei"), (62, items[7][1]), (63, items[7][1])]
    got = by_id(contamination(docs(spark, texts), items_table(spark, items)))
    assert got == brute(texts, items)
    assert sum(r[0]["contaminated"] for r in got.values()) > 5


def test_awkward_rows(spark):
    df, items = awkward(spark, "A-b c"), [(1, "a b c"), (2, "d")]
    got = by_id(contamination(df, items_table(spark, items)))
    assert got[1][0]["n_words"] == got[2][0]["n_words"] == got[3][0]["n_words"] == 0
    assert [r["item_ids"] for r in got[4]] == [["1"], ["1"]] and got[4][0]["n_hit"] == 3
    assert sorted(r["n_hit"] for r in got[None]) == [0, 3]
    assert got[5][0]["n_words"] == 60_000
    assert contamination(df.filter("false"), items_table(spark, items)).count() == 0
    assert contamination(df, items_table(spark, items).filter("false")).filter("contaminated").count() == 0
