import math
import random

import pytest
from pyspark.sql import functions as F

from quartergrid.config import CITIES, POI_FIELDS
from quartergrid.operators import examples as ex
from quartergrid.operators import features as ft
from quartergrid.operators import model as ml
from quartergrid.operators import text_vectors as tv
from quartergrid.sources import tables
from tests.conftest import rows


def vectors(spark):
    return spark.createDataFrame(
        [("road", [1.0, 0.0]), ("exit", [0.0, 1.0]), ("closed", [4.0, 4.0])], "word string, vec array<double>")


def test_text_means(spark):
    texts = spark.createDataFrame(
        [(1, "Road road - EXIT"), (2, "nothing known"), (3, ""), (4, None), (5, "closed.")], "id int, text string")
    got = tv.text_means(texts, vectors(spark), "id", "text", 2)
    # Repeats count; a text without a known token gives no row.
    assert rows(got) == [(1, [pytest.approx(2 / 3), pytest.approx(1 / 3)]), (5, [4.0, 4.0])]


def test_cell_mean_is_a_mean_of_means(spark):
    events = spark.createDataFrame(
        [("a", "road road exit"), ("a", "closed"), ("a", "closed"), ("a", "unknown"), ("b", None), ("b", "exit")],
        "cell string, description string")
    got = dict(rows(tv.cell_means(events, vectors(spark), 2)))
    assert got["a"] == [pytest.approx((2 / 3 + 8) / 3), pytest.approx((1 / 3 + 8) / 3)]
    assert got["b"] == [0.0, 1.0]


def poi(spark, cells):
    return spark.createDataFrame([(c, *([i] * 13), 1) for i, c in enumerate(cells)],
                                 "cell string, " + ", ".join(f"{f} int" for f in POI_FIELDS))


def random_texts(spark, n=400):
    rng = random.Random(13)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(["the", rng.choice(words), "unknown"]) for _ in range(rng.randrange(0, 30))) for _ in range(60)]
    events = [(f"c{rng.randrange(7)}", rng.choice([*texts, None])) for _ in range(n)]
    table = {w: [rng.random() for _ in range(3)] for w in [*words, "the", "unused"]}
    return events, table


@pytest.mark.parametrize("broadcast", [True, False])
def test_cell_means_by_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(tv, "DICTIONARY_BYTES", 0)
        monkeypatch.setattr(tv, "HELD_CELLS", 2)
        monkeypatch.setattr(tv, "HELD_WEIGHTS", 50)
        monkeypatch.setattr(tv, "DENSE_CELLS", 64)
        monkeypatch.setattr(tv, "BLOCKS", 5)
    events, table = random_texts(spark)
    want = {}
    for cell, text in events:
        known = [table[w] for w in (text or "").split() if w in table]
        if known:
            want.setdefault(cell, []).append([sum(v) / len(known) for v in zip(*known)])
    df = spark.createDataFrame(events, "cell string, description string").repartition(4)
    vectors = spark.createDataFrame(list(table.items()), "word string, vec array<double>")
    got = {r.cell: r.vec for r in tv.cell_means(df, vectors, 3).collect()}
    assert set(got) == set(want)
    for cell, means in want.items():
        assert got[cell] == pytest.approx([sum(v) / len(means) for v in zip(*means)])
    assert tv.cell_means(df.filter("false"), vectors, 3).count() == 0
    assert tv.cell_means(df, vectors.filter("false"), 3).count() == 0


def test_dictionary_numbers_words_of_a_block(spark):
    words = spark.createDataFrame([(f"w{i}", [1.0]) for i in range(5000)], "word string, vec array<double>")
    ids = [r.id for r in tv.dictionary(words).collect()]
    by_block = {}
    for i in ids:
        by_block.setdefault(i >> tv.PLACE_BITS, []).append(i & ((1 << tv.PLACE_BITS) - 1))
    assert all(sorted(v) == list(range(len(v))) for v in by_block.values()) and len(by_block) > 900


def test_poi_scaling(spark):
    got = dict(rows(ft.poi_vectors(poi(spark, ["a", "b", "c"]))))
    assert got == {"a": [0.0] * 13 + [0.5], "b": [0.5] * 14, "c": [1.0] * 13 + [0.5]}


def test_poi_scaling_starts_no_job(spark):
    table = poi(spark, ["a", "b", "c"])
    group = "poi-scaling"
    spark.sparkContext.setJobGroup(group, group)
    scaled = ft.poi_vectors(table)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 0
    assert scaled.count() == 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_cell_codes_are_dense_and_alphabetical(spark):
    names = ["9v6kp", "9v6kr", "9q5b3", "9vaaa", "dhxyz", "s0000", "9q5b2"]
    df = spark.createDataFrame([(n,) for n in names + names[:2]], "cell string")
    assert rows(ft.cell_codes(df)) == [(c, i) for i, c in enumerate(sorted(names))]


def test_lookups(spark):
    table = ft.poi_vectors(poi(spark, ["a", "b"]))
    asked = spark.createDataFrame([("a",), ("z",)], "cell string")
    assert rows(ft.attach_poi(asked, table), "cell") == [("a",)]
    assert rows(ft.cells_without_poi(asked, poi(spark, ["a", "b"]))) == [("z",)]
    text = spark.createDataFrame([("a", [1.0, 2.0])], "cell string, vec array<double>")
    assert rows(ft.attach_text(asked, text, 2)) == [("a", [1.0, 2.0]), ("z", [0.0, 0.0])]


def test_split_and_scaling(spark):
    data = [("Austin", "c", s, float(s), 5.0) for s in range(13)] + [("Dallas", "d", s, 2.0 * s, 0.0) for s in range(7)]
    df = spark.createDataFrame(data, "city string, cell string, step long, v double, k double")
    split = ex.chrono_split(df)
    assert rows(ex.chrono_split(df, ex.last_steps(df))) == rows(split)  # whatever is listed
    assert split.filter("city = 'Austin' and split = 'test'").count() == 2     # steps 11, 12
    assert rows(split.filter("city = 'Dallas' and split = 'test'"), "step") == [(6,)]
    scaled = ex.scale_by_train(split, ("v", "k"))
    got = {(r.city, r.step): (r.v, r.k) for r in scaled.collect()}
    assert got["Austin", 5] == (0.5, 0.0) and got["Austin", 12] == (1.2, 0.0)  # unclipped, constant 0
    assert got["Dallas", 6] == (1.2, 0.0)


def series(spark, length=30):
    data = [("Austin", c, "train" if s < 18 else "test", s, [float(s), float(i)], int(s % 7 == 0))
            for i, c in enumerate(("c1", "c2")) for s in range(length)]
    return spark.createDataFrame(
        data, "city string, cell string, split string, step long, features array<double>, predicted_accident int")


def test_lookback(spark):
    got = ex.lookback(series(spark)).collect()
    assert len(got) == 2 * (18 - 8 + 12 - 8)
    for r in got:
        c = float(r.cell == "c2")
        assert r.sequence == [x for s in range(r.step - 8, r.step) for x in (float(s), c)]
        assert r.step >= (8 if r.split == "train" else 26)


@pytest.mark.parametrize("keep_share", [0.0, 0.05, 0.5, 1.0])
def test_sampled_lookback_equals_filtered_lookback(spark, keep_share):
    rows_in = series(spark, 60).repartition(5)
    chosen = ex.is_kept(F.col("predicted_accident"), 1, keep_share)
    cols = ("cell", "split", "step", "sequence")
    assert rows(ex.lookback(rows_in, 8, chosen), *cols) == rows(ex.lookback(rows_in, 8).filter(chosen), *cols)


@pytest.mark.parametrize("keep_share", [0.0, 0.02, 0.3])
def test_needed_rows_give_the_same_sequences(spark, keep_share):
    rows_in = series(spark, 200).repartition(5)
    positives = rows_in.filter("predicted_accident > 0 and step % 5 = 0").select("cell", "step")
    one = rows_in.withColumn("predicted_accident", (F.col("predicted_accident") * (F.col("step") % 5 == 0).cast("int")))
    chosen = ex.is_kept(F.col("predicted_accident"), 1, keep_share)
    cols = ("cell", "split", "step", "sequence")
    near = ex.needed_rows(one, positives, 1, keep_share, 8)
    assert near.count() < one.count()
    assert rows(ex.lookback(near, 8, chosen, dense=True), *cols) == rows(ex.lookback(one, 8).filter(chosen), *cols)


def test_lookback_over_a_table_dealt_by_cell_moves_nothing(spark, tmp_path):
    source = series(spark, 60).drop("features").withColumn("v", F.col("step") * 1.0)
    name = tables.save_bucketed(source.repartition(3, "cell"), f"{tmp_path}/grid", "cell", 3, ("cell", "step"), "city")
    try:
        stored = spark.table(name).withColumn("features", F.array("v"))
        found = ex.lookback(stored, 8, ex.is_kept(F.col("predicted_accident"), 1, 0.2))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" in plan
        want = ex.lookback(source.withColumn("features", F.array("v")), 8, ex.is_kept(F.col("predicted_accident"), 1, 0.2))
        cols = ("cell", "split", "step", "sequence")
        assert rows(found, *cols) == rows(want, *cols)
        assert spark.read.parquet(f"{tmp_path}/grid").count() == source.count()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_ranges_from_step_extremes(spark):
    rng = random.Random(4)
    data = [(c, f"c{i}", s, rng.random(), float(rng.randrange(5))) for c in ("Austin", "Dallas") for i in range(3) for s in range(13)]
    df = spark.createDataFrame(data, "city string, cell string, step long, v double, k double")
    extremes = ex.step_extremes(df, ("v", "k"))
    ends = ex.last_steps(extremes)
    assert rows(ends) == rows(ex.last_steps(df))
    got = ex.train_ranges(ex.chrono_split(extremes, ends), ("v", "k"))
    assert rows(got) == rows(ex.train_ranges(ex.chrono_split(df), ("v", "k")))


def test_sampling_keeps_positives_and_the_share(spark):
    df = spark.range(20000).select(
        F.lit("c").alias("cell"), F.col("id").alias("step"), (F.col("id") % 100 == 0).cast("int").alias("predicted_accident"))
    kept = ex.sample_negatives(df, 42)
    assert kept.filter("predicted_accident = 1").count() == 200
    assert 300 < kept.filter("predicted_accident = 0").count() < 500


def test_metrics_equal_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    data = [(0.0, 0.0)] * 50 + [(0.0, 1.0)] * 7 + [(1.0, 0.0)] * 9 + [(1.0, 1.0)] * 4 + [(1.0, 2.0)]
    df = spark.createDataFrame(data, "label double, prediction double")
    got = ml.class_metrics(df).first()
    for name, value in (("accuracy", got.accuracy), ("weightedRecall", got.weighted_recall), ("f1", got.weighted_f1)):
        assert value == pytest.approx(MulticlassClassificationEvaluator(metricName=name).evaluate(df))
    assert got.accuracy == pytest.approx(got.weighted_recall)


def test_fit_and_score(spark):
    data = [([float(i % 2), float(i % 5)], i % 2) for i in range(200)]
    df = spark.createDataFrame(data, "feature array<double>, label int")
    scored = ml.score(ml.fit(df), df)
    assert ml.class_metrics(scored).first().accuracy == 1.0


def grouped_examples(spark):
    """Three groups of other sizes and slopes, with dependent and constant features."""
    rng = random.Random(11)
    data = []
    for city, n, slope in (("Austin", 900, 1.0), ("Dallas", 300, -2.0), ("Houston", 120, 0.3)):
        for _ in range(n):
            x, y, flag = rng.gauss(3, 2), rng.gauss(0, 40), rng.random() < 0.3
            odds = slope * (x - 3) + 0.02 * y + (0.8 if flag else 0.0) - 0.5
            data.append((city, [x, y, float(flag), float(not flag), 7.0, x + y], int(rng.random() < 1 / (1 + math.exp(-odds)))))
    return spark.createDataFrame(data, "city string, feature array<double>, label int").repartition(5)


def test_groups_are_fitted_like_one_by_one(spark):
    df = grouped_examples(spark)
    got = {r.city: r for r in ml.fit_groups(df, "city").collect()}
    for city in ("Austin", "Dallas", "Houston"):
        own = ml.fit(df.filter(F.col("city") == city), maxIter=1000, tol=1e-12)
        assert got[city].coefficients == pytest.approx(own.coefficients.toArray().tolist(), abs=1e-4)
        assert got[city].intercept == pytest.approx(own.intercept, abs=1e-4)
        assert got[city].passes < 12
    scored = ml.score_groups(ml.fit_groups(df, "city"), df, "city")
    by_city = {r.city: r for r in ml.class_metrics(scored, "city").collect()}
    for city, row in by_city.items():
        one = df.filter(F.col("city") == city)
        want = ml.class_metrics(ml.score(ml.fit(one, maxIter=1000, tol=1e-12), one)).first()
        assert (row.accuracy, row.weighted_recall, row.weighted_f1) == pytest.approx(tuple(want))


def test_groups_with_one_class_separable_classes_or_no_key(spark):
    data = [("one", [1.0, float(i)], 0) for i in range(5)] + [(None, [1.0, 1.0], 1)]
    data += [("apart", [0.0, float(i)], int(i > 9)) for i in range(20)] + [("single", [1.0, 2.0], 1)]
    df = spark.createDataFrame(data, "city string, feature array<double>, label int").repartition(3)
    models = ml.fit_groups(df, "city")
    got = {r.city: r for r in models.collect()}
    assert set(got) == {"one", "apart", "single"}
    assert (got["one"].coefficients, got["one"].intercept) == ([0.0, 0.0], -math.inf)
    assert (got["single"].coefficients, got["single"].intercept) == ([0.0, 0.0], math.inf)
    scored = ml.score_groups(models, df, "city")
    assert scored.count() == 26 and scored.filter("label != prediction").count() == 0
    assert ml.fit_groups(df.filter("false"), "city").count() == 0


def test_groups_are_summed_in_parts(spark, monkeypatch):
    df = grouped_examples(spark)
    want = rows(ml.fit_groups(df, "city"))
    monkeypatch.setattr(ml, "SUM_ROW", 3)
    monkeypatch.setattr(ml, "HELD_GROUPS", 1)
    for a, b in zip(rows(ml.fit_groups(df, "city")), want):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2] == pytest.approx(b[2])


def test_cell_means_at_full_width(spark):
    from quartergrid.operators import text_vectors as tv
    words = {w: [float((i * 31 + ord(w)) % 17) for i in range(100)] for w in "abcd"}
    vectors = spark.createDataFrame(list(words.items()), "word string, vec array<double>")
    texts = [("c1", "a b a"), ("c1", "a b a"), ("c1", "d x"), ("c1", "x y"), ("c2", "c"), ("c2", None), ("c3", "x")]
    events = spark.createDataFrame(texts, "cell string, description string")
    means = tv.cell_means(events, vectors, 100)
    got = {r.cell: r.vec for r in means.collect()}
    assert set(got) == {"c1", "c2"} and got["c2"] == words["c"]
    want = [(2 * (2 * words["a"][i] + words["b"][i]) / 3 + words["d"][i]) / 3 for i in range(100)]
    assert got["c1"] == pytest.approx(want)
    plan = means._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    sums = [line for line in plan.splitlines() if " HashAggregate(" in line and "chunk" in line]
    assert sums and all("*(" in line for line in sums)  # compiled
