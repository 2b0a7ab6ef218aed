from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quartergrid.config import GRID_WINDOW, GridWindow, STEP_FEATURES
from quartergrid.functions import clock, geohash, labels, text
from tests.conftest import rows


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_window_constants():
    assert GRID_WINDOW.total_steps == 8831
    assert len(STEP_FEATURES) == 25
    assert 8 * len(STEP_FEATURES) + 14 + 100 + 1 == 315


def test_known_cells(spark):
    points = [(57.64911, 10.40744, "u4pru"), (30.2672, -97.7431, "9v6kp"), (42.6, -5.6, "ezs42")]
    df = spark.createDataFrame(points, "lat double, lng double, want string")
    got = df.select(geohash.cell_of(F.col("lat"), F.col("lng")).alias("c"), "want").collect()
    assert all(r.c == r.want for r in got)


def halving(lat, lng, precision):
    """Repeated halving by a strict comparison."""
    box = {"x": [-180.0, 180.0, lng], "y": [-90.0, 90.0, lat]}
    bits = ""
    for i in range(5 * precision):
        lo, hi, value = box["xy"[i % 2]]
        mid = (lo + hi) / 2
        bits += "1" if value > mid else "0"
        box["xy"[i % 2]][:2] = [mid, hi] if value > mid else [lo, mid]
    return "".join(geohash.BASE32[int(bits[i:i + 5], 2)] for i in range(0, len(bits), 5))


@pytest.mark.parametrize("precision", [1, 4, 5, 6])
def test_cells_equal_halving_and_round_trip(spark, precision):
    import random

    import numpy as np
    rng = random.Random(7)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    # On boundaries of all sizes, and at the ends of the ranges.
    points += [(0.0, 0.0), (45.0, -90.0), (-90.0, -180.0), (90.0, 180.0), (45 / 1024, -45 / 1024)]
    points = [(float(np.float32(a)), float(np.float32(b))) for a, b in points]
    df = spark.createDataFrame(points, "lat double, lng double").withColumn(
        "cell", geohash.cell_of(F.col("lat"), F.col("lng"), precision)
    )
    row, col = geohash.lattice_of(F.col("cell"), precision)
    back = geohash.cell_of(
        geohash.row_latitude(row, precision), geohash.column_longitude(col, precision), precision
    )
    for r in df.withColumn("back", back).collect():
        assert r.cell == r.back == halving(r.lat, r.lng, precision)


def test_null_point_has_no_cell(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "lat double, lng double")
    assert [r[0] for r in df.select(geohash.cell_of(F.col("lat"), F.col("lng"))).collect()] == [None, None]


def test_clock_text(spark):
    texts = ["6:05 am", "8:10 pm", "12:30 pm", "12:05 am", "7:00 PM", "x", None, "", "9", "5:x pm"]
    want = [365, 1210, 750, 725, 420, 0, 0, 0, 0, 0]
    assert column(spark, texts, "string", clock.clock_minutes) == want


def test_observation_time(spark):
    df = spark.createDataFrame(
        [("2018-06-01", "1:53 PM"), ("2018-06-01", "12:05 am"), ("2018-6-1", "01:05 AM"),
         ("2018-06-01", "25:61 xx"), (None, "1:00 AM"), ("2018-06-01", None)], "d string, h string")
    got = [r[0] for r in df.select(clock.observation_time(F.col("d"), F.col("h"))).collect()]
    assert got == [datetime(2018, 6, 1, 13, 53), datetime(2018, 6, 1, 0, 5),
                   datetime(2018, 6, 1, 1, 5), None, None, None]


def test_step_index_and_zones(spark):
    window = GridWindow(datetime(2018, 6, 1), datetime(2018, 6, 1, 23, 59, 59))
    data = [("2018-06-01 04:59:59", "US/Central", -1), ("2018-06-01 05:00:00", "US/Central", 0),
            ("2018-06-01 05:14:59.9", "US/Central", 0), ("2018-06-01 05:15:00", "US/Central", 1),
            ("2018-06-01 04:00:00", "US/Eastern", 0), ("2018-06-01 07:00:00", "US/Pacific", 0),
            ("2018-06-02 04:59:59", "US/Central", 95), ("2018-06-02 04:59:59.5", "US/Central", -1)]
    df = spark.createDataFrame(data, "t string, zone string, want long").withColumn(
        "got", clock.step_index(clock.local_time(F.col("t").cast("timestamp"), F.col("zone")), window))
    assert [r.got for r in df.collect()] == [d[2] for d in data]


def test_hour_classes_and_weekdays(spark):
    got = column(spark, range(24), "int", clock.hour_class)
    assert got == [4] * 6 + [0] * 4 + [1] * 5 + [2] * 3 + [3] * 4 + [4] * 2
    assert column(spark, range(7), "int", clock.weekday_flag) == [1] * 5 + [0] * 2
    df = spark.createDataFrame([(i,) for i in range(5)], "c int")
    onehot = [list(r) for r in df.orderBy("c").select(*labels.hour_onehot(F.col("c"))).collect()]
    assert onehot == [[1.0 if i == j else 0.0 for j in range(5)] for i in range(5)]


def test_event_classes(spark):
    types = ["Other", "Other-x", "Lane-Blocked", "Foo-Bar", "Accident", "Broken-Vehicle",
             "Flow-Incident", "Event", None]
    want = ["Other", "Other", "RoadBlocked", "Foo", "Accident", "BrokenVehicle", "FlowIncident",
            "Event", None]
    assert column(spark, types, "string", labels.event_class) == want
    sums = column(spark, ["Other", "Foo", "Accident"], "string",
                  lambda c: sum(labels.class_indicators(c).values(), F.lit(0)))
    assert sums == [0, 1, 1]


def test_tag_classes(spark):
    tags = ["Light Rain , Snow", "Heavy Drizzle", "Snow", "Haze", "Ice Pellets", "", None, "Clear", "FOG"]
    want = ["w_rain", "w_rain", "w_snow", "w_fog", "w_hail", None, None, None, "w_fog"]
    assert column(spark, tags, "string", labels.tag_class) == want


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="aB -./\\;,&!?()[]{}\n|é", max_size=30), min_size=20, max_size=40))
def test_tokens_equal_regex_split(spark, texts):
    import re
    pattern = re.compile(r" - | |\.|\\|/|;|,|&|!|\?|\(|\)|\[|\]|\{|\}")
    want = [[t.lower() for t in pattern.split(x) if t] for x in texts]
    assert column(spark, texts, "string", text.tokens) == want
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    assert rows(text.token_rows(df, "i", "t")) == sorted(
        ((i, w) for i, ws in enumerate(want) for w in ws), key=repr)


def test_no_tokens_for_null(spark):
    assert column(spark, [None, "", "a - b"], "string", text.tokens) == [[], [], ["a", "b"]]


def test_draw_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.lit("9v6kp").alias("cell"), F.col("id").alias("step"))
    draw = labels.keyed_draw(42, F.col("cell"), F.col("step")).alias("d")
    once = rows(df.repartition(1).select("step", draw))
    assert once == rows(df.repartition(7).select("step", draw))
    assert all(0 <= d < 10000 for _, d in once)
