import random
import re

from quartergrid.llm.quality_rules import quality_verdicts

from .cases import awkward, by_id, docs, prose


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
            "base_failed": len(words) < 10 or 100 * len(repeated) > 20 * len(words)}


def test_base_counts_equal_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for i in range(60):
        w = prose(rng, rng.randrange(0, 60), 4 if i % 3 else 400)
        texts.append(rng.choice([" ", "\n", " é ", "##| ", "\t"]).join(w))
    texts += ["a a a a a a a", "x\nx\n\nx \n \n", "日本 語 " * 9, "\x1cé\x85 b"]
    got = by_id(quality_verdicts(docs(spark, texts)))
    for i, t in enumerate(texts):
        want = base(t)
        assert {k: got[i][0][k] for k in want} == want, t
        assert not (got[i][0]["kept"] and want["base_failed"])


def test_bands_reject_what_lies_far_out(spark):
    rng = random.Random(5)
    clean = [" ".join(rng.choice("the quick brown fox jumps over lazy dogs while many people walk home after dark and "
                                 "nobody minds it very much".split()) + str(rng.randrange(10)) * (rng.random() < 0.1)
                      for _ in range(rng.randrange(70, 100))) for _ in range(120)]
    junk = [" ".join(f"{rng.choice('qzxkv')}{rng.choice('QZXKJ')}~^{rng.randrange(9)}$%" for _ in range(14)) for _ in range(3)]
    got = by_id(quality_verdicts(docs(spark, clean + junk + [clean[0]] * 200)))
    assert all(got[i][0]["kept"] for i in range(len(clean)) if not got[i][0]["base_failed"])
    assert not any(got[len(clean) + i][0]["kept"] for i in range(len(junk)))


def test_measures(spark):
    got = by_id(quality_verdicts(docs(spark, ["Γειά σου Κόσμε", "привет мир", "日本語 日本語", "!!! 123", "\U00012000 a"])))
    assert [got[i][0]["script"] for i in range(5)] == ["Greek", "Cyrillic", "Han", "none", "Latin"]
    assert got[4][0]["byte_share"] == 4 / 5 and got[0][0]["byte_share"] == 0


def test_awkward_rows(spark):
    got = by_id(quality_verdicts(awkward(spark)))
    for k in (1, 2, 3):
        r = got[k][0]
        assert r["base_failed"] and not r["kept"] and r["n_words"] == 0 and r["script"] == "none"
    assert len(got[4]) == 2 and len(got[None]) == 2
    assert got[5][0]["n_words"] == 60_000 and got[5][0]["kept"]
    assert quality_verdicts(awkward(spark).filter("false")).count() == 0
    assert quality_verdicts(awkward(spark).select("doc_id", "text")).count() == 9


def plain(rng, n):
    return " ".join(rng.choice("the quick brown fox jumps over lazy dogs while many people walk home after dark and nobody "
                               "minds it very much".split()) + str(rng.randrange(10)) * (rng.random() < 0.1) for _ in range(n))


def junk(rng, n):
    return " ".join(f"{rng.choice('qzxkv')}{rng.choice('QZXKJ')}~^{rng.randrange(9)}$%" for _ in range(n))


def test_small_groups_are_judged_by_wider_ones(spark):
    rng = random.Random(6)
    clean = [plain(rng, rng.randrange(70, 100)) for _ in range(120)]
    # The only texts of their size, of their language, and of a script that does not fit it.
    rare = [(junk(rng, 900), "en"), (junk(rng, 14), "fi"), ("лщ~^7$% " * 2 + junk(rng, 30), "fi"), (plain(rng, 400), "en"),
            (plain(rng, 40), "fi")]
    texts = clean + [t for t, _ in rare]
    table = docs(spark, texts, ["en"] * len(clean) + [lang for _, lang in rare])
    got = by_id(quality_verdicts(table))
    assert not any(got[i][0]["base_failed"] for i in range(len(clean), len(texts)))
    assert [got[i][0]["kept"] for i in range(len(clean), len(texts))] == [False, False, False, True, True]

    from corpus_pipeline import quality_rules

    left = {r["doc_id"] for r in quality_rules(spark, table, "").select("doc_id").collect()}
    assert left == {i for i in got if got[i][0]["kept"]} and {123, 124} < left


def test_marks_after_every_word_lie_outside_the_bands(spark):
    rng = random.Random(8)
    clean = [plain(rng, rng.randrange(300, 400)) for _ in range(120)]
    marked = [" ".join(w + "%" * (k % 6 == 0) for k, w in enumerate(plain(rng, 340).split())) for _ in range(3)]
    spelt = [" ".join(w + "\U00012000" * (k % 20 == 0) for k, w in enumerate(plain(rng, 340).split())) for _ in range(3)]
    got = by_id(quality_verdicts(docs(spark, clean + marked + spelt)))
    assert not any(r[0]["base_failed"] for r in got.values())
    assert sum(got[i][0]["kept"] for i in range(120)) >= 118
    assert not any(got[i][0]["kept"] for i in range(120, 126))
