import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quartergrid.operators import text_vectors as tv


@pytest.mark.parametrize("held", [1, 20, 1 << 21])
def test_counts_of_keys_that_repeat_or_are_null(spark, monkeypatch, held):
    monkeypatch.setattr(tv, "HELD_WEIGHTS", held)
    monkeypatch.setattr(tv, "HELD_BYTES", held)
    rng = random.Random(3)
    data = [(rng.choice([None, *range(9)]), " ".join(rng.choice("abcDEF") for _ in range(rng.randrange(12)))) for _ in range(120)]
    want = Counter((k, w.lower()) for k, t in data for w in t.split())
    vectors = spark.createDataFrame([(w, [1.0]) for w in "abcde"], "word string, vec array<double>")
    got = tv.token_vectors(spark.createDataFrame(data, "id int, text string"), vectors, "id", "text").collect()
    assert {(r.id, r.word): r.uses for r in got} == {kw: n for kw, n in want.items() if kw[1] in "abcde"}
    assert len(got) == len({(r.id, r.word) for r in got})


def test_word_meets_its_vector_once_for_all_texts_of_a_task(spark):
    """Not once for each text that uses it."""
    df = spark.range(5000).select("id", F.lit("the road, the exit").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tv.postings(df, "id", "text").count() <= 3 * parts
    assert tv.token_counts(df, "id", "text").count() == 15000


def test_means_of_groups_with_gaps_in_vectors(spark, monkeypatch):
    monkeypatch.setattr(tv, "HELD_CELLS", 3 * 7)  # seven texts a group
    monkeypatch.setattr(tv, "DENSE_CELLS", 12)
    df = spark.createDataFrame([(i if i % 9 else None, "a b" if i % 2 else "a c c x") for i in range(60)], "id int, text string")
    vectors = spark.createDataFrame([("a", [1.0, None]), ("b", [3.0, None, 9.0]), ("c", [7.0])], "word string, vec array<double>")
    got = {r.id: r.vec for r in tv.text_means(df, vectors, "id", "text", 2).collect()}
    assert len(got) == 54 and got[1] == [2.0, None] and got[2] == [5.0, None]
    assert got[None] == [pytest.approx((3 * 4 + 4 * 15) / (3 * 2 + 4 * 3)), None]


def test_work_of_a_cell_mean_is_by_text(spark):
    """A text is split and multiplied once, however many cells share it."""
    text = " ".join(f"w{i}" for i in range(200))
    events = spark.range(3000).select(F.concat(F.lit("c"), (F.col("id") % 1000).cast("string")).alias("cell"), F.lit(text).alias("description"))
    vectors = spark.createDataFrame([(f"w{i}", [float(i)]) for i in range(200)], "word string, vec array<double>")
    stages = {}

    def stage(name, df):
        stages[name] = df.count()
        return df

    got = tv.cell_means(events, vectors, 1, stage).collect()
    assert stages == {"texts": 1}
    assert len(got) == 1000 and all(r.vec == [pytest.approx(99.5)] for r in got)
