import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartergrid.llm import language_id as li

from .cases import awkward, by_id, docs

EN = "the house stands on a hill and nobody has lived there for many years they say"
DE = "das haus steht auf einem hügel und niemand hat dort seit vielen jahren gewohnt"


def grams(text):
    """Hashed n-grams of one text, by the plain definition of what is hashed."""
    return [int(b) for buckets, _ in li.ngrams([text]) for b in buckets]


def test_ngrams_skip_what_is_no_letter_and_stay_within_texts():
    assert sorted(grams("a--b")) == sorted(grams("A 12 b"))
    both = [(int(b), int(o)) for bs, os_ in li.ngrams(["ab", "", "cd", "12"]) for b, o in zip(bs, os_)]
    assert Counter(b for b, o in both if o == 0) == Counter(grams("ab"))
    assert Counter(b for b, o in both if o == 2) == Counter(grams("cd"))
    assert {o for _, o in both} == {0, 2}


def test_model_equals_brute_force(spark):
    rows = [(i, " ".join(t.split()[i % 5 :])) for i, t in enumerate([EN, DE] * 6)]
    df = docs(spark, rows, ["en", "de"])
    names, weights, priors = li.train(df)
    counts, n = defaultdict(Counter), Counter()
    for (i, t) in rows:
        counts[["en", "de"][i % 2]].update(grams(t))
        n[["en", "de"][i % 2]] += 1
    assert names == ["de", "en"]
    for k, name in enumerate(names):
        total = sum(counts[name].values()) + 2**li.BUCKET_BITS
        assert priors[k] == pytest.approx(math.log(n[name] / len(rows)))
        for b in list(counts[name])[:50]:
            assert weights[k, b] == pytest.approx(math.log((counts[name][b] + 1) / total), rel=1e-5)
    text = "the house on jahren"
    lettered, total = li.scores([text, "12"], weights, priors)
    assert list(lettered) == [True, False]
    assert total[0] == pytest.approx([priors[k] + sum(float(weights[k, b]) for b in grams(text)) for k in (0, 1)], rel=1e-5)


def test_held_out_accuracy(spark):
    source = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    got = li.identify_languages(source, held).join(source.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 150 and (out.lang == out.lang_pred).mean() > 0.99
    assert got.score.between(0, 1).all()


def test_long_texts_in_parts(spark, monkeypatch):
    whole = Counter(grams(EN * 3))
    monkeypatch.setattr(li, "BATCH_CHARS", 50)
    parts = Counter(grams(EN * 3))
    assert set(parts) == set(whole) and sum((parts - whole).values()) < 40


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_parts_count_each_ngram_once(monkeypatch, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab cé-1İ\n") for _ in range(rng.randrange(60))) for _ in range(40)] + ["---- a", "a" + "-" * 99 + "b"]
    whole = [Counter(grams(t)) for t in texts]
    monkeypatch.setattr(li, "BATCH_CHARS", size)
    assert [Counter(grams(t)) for t in texts] == whole


def test_awkward_rows(spark):
    got = by_id(li.identify_languages(awkward(spark, EN), F.lit(False)))
    assert got[1] == got[2] == got[3] == [{"held_out": False, "lang_pred": "und", "score": 0.0}]
    assert [r["lang_pred"] for r in got[4]] == ["en", "en"] and len(got[None]) == 2
    none = by_id(li.identify_languages(docs(spark, [EN, "12"]), F.lit(True)))
    assert {r["lang_pred"] for rows in none.values() for r in rows} == {"und"}
    assert li.identify_languages(awkward(spark).filter("false"), F.lit(False)).count() == 0
    assert np.isfinite(li.train(docs(spark, [None, "a"]))[1]).all()


def test_any_number_of_languages_in_blocks(spark):
    rng = random.Random(11)
    names = [f"l{i:02}" for i in range(9)]
    rows = []
    for i in range(90):
        letters = "abcdefghijklmnopqrstuvwxyz"[i % 9 : i % 9 + 9]
        rows.append((i, " ".join("".join(rng.choices(letters, k=5)) for _ in range(12))))
    df = docs(spark, rows + [(90, ""), (91, None), (92, "1 2")], names)
    counted = li.counts(df.filter("doc_id < 90"))
    whole = {r["doc_id"]: r for r in li.predict(df, counted, "doc_id").collect()}
    assert {whole[i]["lang_pred"] for i in (90, 91, 92)} == {"und"}
    assert sum(whole[i]["lang_pred"] == names[i % 9] for i in range(90)) > 80
    for size in (1, 2, 4, 9):
        parts = {r["doc_id"]: r for r in li.predict(df, counted, "doc_id", size=size).collect()}
        assert {i: r["lang_pred"] for i, r in parts.items()} == {i: r["lang_pred"] for i, r in whole.items()}
        for i, r in parts.items():
            assert r["score"] == pytest.approx(whole[i]["score"], rel=1e-9)
    joined = li.train(df.filter("doc_id < 90"))
    assert joined.names == names and np.exp(joined.priors).sum() == pytest.approx(1)
