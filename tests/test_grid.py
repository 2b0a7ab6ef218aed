import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quartergrid.config import CITIES, FLAG_COLUMNS, GridWindow, WEATHER_MEASURES
from quartergrid.functions.geohash import BASE32, great_circle_km
from quartergrid.operators import events as ev
from quartergrid.operators import grid as gr
from quartergrid.operators import nearest as nr
from quartergrid.operators import observations as ob
from quartergrid.plans import pipeline as pl
from tests.conftest import rows
from tests.test_events import WINDOW, random_events, spans

SMALL = GridWindow(datetime(2018, 6, 1), datetime(2018, 6, 1, 2, 59, 59))  # 11 steps, 12 slots


def observations(spark, data):
    """(airport, minute after midnight, temperature, humidity, conditions, events)."""
    df = spark.createDataFrame(
        [(i, a, m, t, h, c, e) for i, (a, m, t, h, c, e) in enumerate(data)],
        "obs_id int, airport string, m int, temperature double, humidity double, "
        "conditions string, events string")
    at = F.timestamp_seconds(F.lit(1527811200) + F.col("m") * 60)
    return df.withColumn("ts_local", at).withColumns(
        {m: F.lit(1.0) for m in WEATHER_MEASURES if m not in ("temperature", "humidity")})


def test_fill_takes_the_next_observed_step(spark):
    obs = observations(spark, [
        ("A", 47, 5.0, 1.0, "", ""), ("A", 46, 6.0, 1.0, "", ""),    # step 3: the earlier wins
        ("A", 46, 7.0, 1.0, "", ""),                                 # tie: lower id wins
        ("A", 100, 8.0, 1.0, "", ""),                                # step 6
        ("A", 5000, 9.0, 1.0, "", ""),                               # outside
        ("B", 179, 4.0, 1.0, "", ""),                                # last slot: fills to step 10
    ])
    got = rows(ob.explode_fill(ob.fill_backward(obs, SMALL)), "airport", "step", "temperature")
    assert got == sorted([("A", s, 6.0) for s in range(4)] + [("A", s, 8.0) for s in range(4, 7)]
                         + [("B", s, 4.0) for s in range(11)], key=repr)


def test_first_per_step_is_a_hash_aggregate(spark):
    rng = random.Random(8)
    data = [(rng.choice("AB"), rng.randrange(200), float(i), 1.0, "", "") for i in range(500)]
    obs = observations(spark, data).repartition(4)
    first = ob.first_per_step(obs, SMALL)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "HashAggregate" in plan
    best = {}
    for i, (a, m, t, *_) in enumerate(data):
        best.setdefault((a, m // 15), []).append((m, i, t))
    assert rows(first, "airport", "step", "temperature") == sorted(((*k, min(v)[2]) for k, v in best.items() if k[1] < 12), key=repr)


def test_weather_of_sets(spark):
    obs = observations(spark, [
        ("A", 0, 10.0, -9999.0, "Light Rain , Snow", None), ("B,1", 0, 20.0, -9999.0, "Haze", "Hail"),
        ("A", 15, -9999.0, 4.0, None, ""), ("A", 16, 99.0, 9.0, "Snow", "Snow"),
    ])
    pairs = spark.createDataFrame([("c1", "B,1"), ("c1", "A"), ("c2", "A"), ("c3", "Z")],
                                  "cell string, airport string")
    sets = ob.airport_sets(pairs)
    assert rows(sets) == [("c1", ["A", "B,1"]), ("c2", ["A"]), ("c3", ["Z"])]
    spans_ = ob.measured_spans(ob.fill_backward(obs, SMALL))
    weather = ob.set_weather(sets, spans_, SMALL)
    assert weather.count() == 3 * SMALL.total_steps
    got = {("+".join(r.airport_set), r.step): r for r in weather.collect()}
    first = got["A+B,1", 0]
    # Means over valid values only; no valid value at all is 0.
    assert (first.w_temperature, first.w_humidity) == (15.0, 0.0)
    assert tuple(first[f] for f in FLAG_COLUMNS) == (1, 0, 1, 1)  # rain beats snow in one tag
    # A no-value mark in the chosen observation is not replaced by a later one.
    assert (got["A", 1].w_temperature, got["A", 1].w_humidity) == (0.0, 4.0)
    assert got["A+B,1", 2].w_temperature == 0.0 and got["Z", 0].w_wind_speed == 0.0


def brute_nearest(spark, missing, donors):
    cells = sorted(set(missing) | set(donors))
    from quartergrid.functions.geohash import column_longitude, lattice_of, row_latitude
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    r, c = lattice_of(F.col("cell"))
    points = df.select("cell", row_latitude(r).alias("lat"), column_longitude(c).alias("lng"))
    pairs = points.filter(F.col("cell").isin(missing)).crossJoin(
        points.filter(F.col("cell").isin(donors)).select(
            F.col("cell").alias("donor"), F.col("lat").alias("b"), F.col("lng").alias("c")))
    km = great_circle_km(F.col("lat"), F.col("lng"), F.col("b"), F.col("c"))
    return pairs.groupBy("cell").agg(F.min(F.struct(km.alias("km"), "donor")).alias("m")).select(
        "cell", "m.donor", "m.km")


@pytest.mark.parametrize("seed,prefix", [(1, ""), (2, "9v"), (3, "9v6"), (4, "8"), (5, "zz")])
def test_nearest_equals_brute_force(spark, seed, prefix):
    rng = random.Random(seed)
    pool = {prefix + "".join(rng.choice(BASE32) for _ in range(5 - len(prefix))) for _ in range(60)}
    if prefix in ("8", "zz"):  # across the date line, and next to the pole
        pool |= {"x" + "".join(rng.choice(BASE32) for _ in range(4)) for _ in range(20)}
    pool = sorted(pool)
    donors, missing = pool[::4], [c for i, c in enumerate(pool) if i % 4]
    as_df = lambda names: spark.createDataFrame([(n,) for n in names], "cell string")
    got = nr.nearest_cells(as_df(missing), as_df(donors))
    assert rows(got, "cell", "donor") == rows(brute_nearest(spark, missing, donors), "cell", "donor")


def probes(spark, missing, donors):
    """Pairs of boxes that the search looks at."""
    as_df = lambda names: spark.createDataFrame([(n,) for n in names], "cell string")
    return nr.probe_counts(as_df(missing), as_df(donors))


def test_far_donors_take_few_probes(spark):
    rng = random.Random(6)
    donors = ["r3" + "".join(rng.choice(BASE32) for _ in range(3)) for _ in range(500)]
    counts = probes(spark, ["9v6kp"], donors)  # on another continent, no letter in common
    assert len(counts) == 5 and sum(counts) <= 400 and max(counts) < 200
    near = probes(spark, ["9v6kp"], ["9v6kr", *donors])
    assert sum(near) <= 60
    many = sorted({"9" + "".join(rng.choice(BASE32) for _ in range(4)) for _ in range(800)})
    assert sum(probes(spark, many[::2], many[1::2])) < 200 * len(many[::2])


@pytest.mark.parametrize("precision", [1, 2, 3, 4, 6, 7])
def test_nearest_at_other_precisions(spark, precision):
    from quartergrid.functions.geohash import column_longitude, lattice_of, row_latitude
    rng = random.Random(precision)
    pool = sorted({"".join(rng.choice(BASE32) for _ in range(precision)) for _ in range(40)})
    donors, missing = pool[::3], [c for i, c in enumerate(pool) if i % 3]
    as_df = lambda names: spark.createDataFrame([(n,) for n in names], "cell string")
    got = nr.nearest_cells(as_df(missing), as_df(donors), precision)
    r, c = lattice_of(F.col("cell"), precision)
    points = as_df(pool).select("cell", row_latitude(r, precision).alias("lat"), column_longitude(c, precision).alias("lng"))
    pairs = points.filter(F.col("cell").isin(missing)).crossJoin(points.filter(F.col("cell").isin(donors)).toDF("donor", "b", "c"))
    km = great_circle_km(F.col("lat"), F.col("lng"), F.col("b"), F.col("c"))
    want = pairs.groupBy("cell").agg(F.min(F.struct(km.alias("km"), "donor")).alias("m")).select("cell", "m.donor")
    assert rows(got, "cell", "donor") == rows(want)


def test_single_far_donor(spark):
    as_df = lambda names: spark.createDataFrame([(n,) for n in names], "cell string")
    assert rows(nr.nearest_cells(as_df(["9v6kp"]), as_df(["r3gx2"])), "donor") == [("r3gx2",)]


def test_borrowing_uses_original_cells_only(spark):
    cells = spark.createDataFrame([("a", c) for c in ("9v6kp", "9v6kr", "9v6kx", "9v6s8")], "city string, cell string")
    pairs = spark.createDataFrame([("9v6kp", "KAUS"), ("9v6kp", "KEDC"), ("9v6s8", "KATT")], "cell string, airport string")
    got = nr.complete_airports(cells, pairs)
    owners = {c: {a for x, a in rows(got) if x == c} for c in ("9v6kr", "9v6kx")}
    assert owners["9v6kr"] == {"KAUS", "KEDC"}
    assert owners["9v6kx"] in ({"KAUS", "KEDC"}, {"KATT"})


def test_no_donor_at_all(spark):
    cells = spark.createDataFrame([("a", "9v6kp")], "city string, cell string")
    pairs = spark.createDataFrame([], "cell string, airport string")
    assert rows(nr.complete_airports(cells, pairs)) == []


def daylight(spark):
    return spark.createDataFrame([("Austin-TX", datetime(2018, 6, 1).date(), 390, 1230)],
                                 "place string, day date, sunrise int, sunset int")


def test_daylight(spark):
    got = gr.daylight_flags(daylight(spark), CITIES, WINDOW)
    lit = [s for c, s, d in rows(got) if c == "Austin" and d == 1]
    assert lit == sorted(range(26, 83), key=lambda s: repr(("Austin", s, 1)))  # 6:30 to 20:30, both in
    assert got.filter("city <> 'Austin' and daylight = 1").count() == 0
    assert gr.places_without_daylight(daylight(spark), CITIES).count() == 5
    missing = gr.days_without_daylight(daylight(spark), CITIES, WINDOW)
    assert missing.filter("city <> 'Austin'").count() == 5 * missing.filter("city = 'Dallas'").count() > 0


def test_blocks_hold_gaps(spark):
    table = spark.createDataFrame([("k", 1, 5), ("k", 97, 6)], "key string, step long, v int")
    got = {r.block: r.key_rows for r in gr.in_blocks(table, "key", WINDOW).collect()}
    assert [len(v) for v in got.values()] == [96, 96]
    assert got[0][0] is None and got[0][1].v == 5 and got[1][1].v == 6 and got[1][2] is None


@pytest.fixture(scope="module")
def parts(spark):
    held = spans(spark, random_events()).select(
        "city", "city_order", "zone", "cell", "airport", "class", "start_step", "stop_step")
    s = pl.Settings(window=WINDOW)
    sets = pl.airport_sets(ev.seen_places(held), s)
    obs = observations(spark, [("KAUS", m, float(m), 2.0, "Rain", "") for m in range(0, 2000, 37)])
    weather = pl.set_weather(sets, obs, s)
    codes = ev.registered_cells(held).select("cell").distinct().withColumn("cell_code", F.lit(3))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(gr, "BLOCKS_PER_TASK", 4)
        grid = pl.raw_grid(held, sets, weather, daylight(spark), codes, s).cache()
    return held, sets, weather, grid


def test_stretching_uses_the_whole_cluster():
    for blocks, slots in ((2772, 8), (50_000, 8), (10**9, 4000), (3, 8), (0, 8)):
        tasks = gr.stretch_tasks(blocks, slots)
        assert tasks == max(1, blocks) if blocks < slots else tasks % slots == 0
        assert blocks / tasks <= gr.BLOCKS_PER_TASK


def test_grid_rows_are_spread(spark, parts):
    sizes = [r["count"] for r in parts[3].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= spark.sparkContext.defaultParallelism


def test_grid_equals_joined_grid(spark, parts):
    held, sets, weather, grid = parts
    steps = ev.registered_cells(held).withColumn(
        "step", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(190).cast("long"))))
    want = (
        steps.join(ev.cell_step_counts(held, WINDOW), ["city", "cell", "step"], "left")
        .join(ob.cell_weather(sets, weather), ["cell", "step"], "left")
        .join(gr.daylight_flags(daylight(spark), CITIES, WINDOW), ["city", "step"], "left")
        .fillna(0)
    )
    common = [c for c in want.columns if c in grid.columns]
    assert len(common) == 3 + 8 + 10 + 1
    assert grid.select(F.spark_partition_id()).distinct().count() > 1
    assert rows(grid.select(*common)) == rows(want.select(*common))


def test_label_from_runs_equals_window(parts):
    grid = parts[3]
    by_runs = gr.next_step_label(grid)
    by_window = gr.next_step_label(grid.drop("next_accidents"))
    keys = ("city", "cell", "step", "t_accident", "predicted_accident")
    assert rows(by_runs, *keys) == rows(by_window, *keys)
    assert by_runs.agg(F.max("step")).first()[0] == 189
    assert by_runs.filter("predicted_accident = 1").count() > 0


def test_next_step_label_by_hand(spark):
    series = [0, 2, 0, 0, 1, 1, 0, 0, 0, 3]
    df = spark.createDataFrame([("a", "c", i, v) for i, v in enumerate(series)],
                               "city string, cell string, step long, t_accident int")
    got = rows(gr.next_step_label(df), "step", "t_accident", "predicted_accident")
    flags = [1 if v else 0 for v in series]
    assert got == [(i, flags[i], flags[i + 1]) for i in range(9)]


def test_clean_grid_drops_cells_without_code(spark, parts):
    grid = parts[3]
    some = grid.select("cell").distinct().limit(1).withColumn("cell_code", F.lit(0))
    clean = gr.clean_grid(grid.drop("cell_code"), some)
    assert clean.select("cell").distinct().count() == 1 and clean.count() == 190
