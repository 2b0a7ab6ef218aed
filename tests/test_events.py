from datetime import datetime

from pyspark.sql import functions as F

from quartergrid.config import CITIES, GridWindow, TRAFFIC_COLUMNS
from quartergrid.functions.labels import class_indicators
from quartergrid.operators import events as ev
from tests.conftest import rows

WINDOW = GridWindow(datetime(2018, 6, 1), datetime(2018, 6, 2, 23, 59, 59))  # 191 steps, 192 slots
AUSTIN = (30.2672, -97.7431)


def traffic(spark, data):
    """(type, start, end[, airport, lat, lng]) in UTC; Austin is five hours behind."""
    full = [(i, d[0], d[1], d[2], *(d[3:] or ("KAUS", *AUSTIN))) for i, d in enumerate(data)]
    df = spark.createDataFrame(
        full, "event_id int, type string, s string, e string, airport string, lat double, lng double")
    return df.withColumn("start_utc", F.try_to_timestamp("s")).withColumn(
        "end_utc", F.try_to_timestamp("e")).drop("s", "e")


def spans(spark, data):
    return ev.prepare_spans(traffic(spark, data), CITIES, datetime(2018, 5, 1), datetime(2018, 7, 1), WINDOW)


def test_period_is_half_open(spark):
    data = [("Event", t, t) for t in ("2018-05-31 23:59:59", "2018-06-01 00:00:00",
                                      "2018-06-02 23:59:59", "2018-06-03 00:00:00", "bad")]
    kept = ev.in_period(traffic(spark, data), datetime(2018, 6, 1), datetime(2018, 6, 3))
    assert rows(kept, "event_id") == [(1,), (2,)]


def test_city_boxes_are_open(spark):
    box = CITIES[2]
    t = "2018-06-01 12:00:00"
    data = [("Event", t, t, "KAUS", lat, lng) for lat, lng in (
        AUSTIN, (box.lat_min, -97.7), (box.lat_max, -97.7), (30.2, box.lng_min), (0.0, 0.0), (33.7, -84.4))]
    got = ev.assign_cities(traffic(spark, data), CITIES)
    assert rows(got, "event_id", "city", "zone") == [
        (0, "Austin", "US/Central"), (5, "Atlanta", "US/Eastern")]


def test_overlapping_boxes_give_a_row_each(spark):
    twin = CITIES + (CITIES[2].__class__("Twin", 29.0, 31.0, -98.0, -97.0, "US/Central", "TX"),)
    t = "2018-06-01 12:00:00"
    got = ev.assign_cities(traffic(spark, [("Event", t, t)]), twin)
    assert rows(got, "city") == [("Austin",), ("Twin",)]


def test_rejects(spark):
    t = "2018-06-01 12:00:00"
    good, bad = ev.split_unusable(traffic(spark, [("Event", t, t), ("Event", t, "x"), (None, t, t)]))
    assert rows(good, "event_id") == [(0,)]
    assert rows(bad, "event_id", "reject") == [(1, "end"), (2, "type")]


def test_spans(spark):
    data = [
        ("Event", "2018-06-01 04:59:59", "2018-06-01 06:00:00"),     # starts before: dropped
        ("Event", "2018-06-01 05:00:00", "2018-06-01 05:31:00"),     # 0..2
        ("Accident", "2018-06-01 05:00:00", "2018-06-01 09:00:00"),  # 0 only
        ("Event", "2018-06-03 04:40:00", "2018-06-05 00:00:00"),     # end outside: moved to 190
        ("Event", "2018-06-03 04:50:00", "2018-06-05 00:00:00"),     # starts in the last slot, 191 > 190
        ("Event", "2018-06-03 04:50:00", "2018-06-03 04:55:00"),     # last slot 191
        ("Event", "2018-06-01 07:00:00", "2018-06-01 06:00:00"),     # end before start: dropped
        ("Accident", "2018-06-01 07:00:00", "2018-06-01 06:00:00"),  # kept
        ("Event", "2018-06-03 05:00:00", "2018-06-03 06:00:00"),     # starts after: dropped
    ]
    steps = ev.explode_spans(spans(spark, data))
    assert rows(steps, "event_id", "step") == [
        (1, 0), (1, 1), (1, 2), (2, 0), (3, 190), (5, 191), (7, 8)]


def random_events(n=400):
    import random
    rng = random.Random(3)
    kinds = ["Accident", "Other", "Other-x", "Foo", "Congestion", "Broken-Vehicle", "Lane-Blocked"]
    base = datetime(2018, 6, 1)
    from datetime import timedelta
    out = []
    for _ in range(n):
        start = base + timedelta(minutes=rng.randrange(0, 3200))
        end = start + timedelta(minutes=rng.choice([-30, 0, 10, 50, 400, 4000]))
        out.append((rng.choice(kinds), str(start), str(end), rng.choice(["KAUS", "KED", None, "KATT"]),
                    30.2 + 0.05 * rng.randrange(3), -97.8 + 0.05 * rng.randrange(3)))
    return out


def test_counts_by_changes_equal_counts_by_explosion(spark):
    held = spans(spark, random_events())
    marks = class_indicators(F.col("class"))
    want = ev.explode_spans(held).groupBy("city", "cell", "step").agg(
        *(F.sum(marks[c]).alias(c) for c in TRAFFIC_COLUMNS))
    got = ev.cell_step_counts(held, WINDOW)
    assert rows(got) == rows(want.select(*got.columns))
    # Rows whose only events are literally "Other" are there, with zeros.
    assert any(sum(r[3:]) == 0 for r in rows(got))


def test_runs_cover_every_step_once(spark):
    held = spans(spark, random_events())
    runs = ev.count_runs(held, WINDOW)
    steps = runs.filter("step < 191").select("city", "cell", F.explode(F.sequence(
        F.col("step"), F.least("next_step", F.lit(191)) - 1)).alias("step"))
    cells = ev.registered_cells(held).count()
    assert steps.count() == steps.distinct().count() == cells * 191


def test_row_order_and_partitions_do_not_matter(spark):
    held = spans(spark, random_events())
    once = rows(ev.cell_step_counts(held.repartition(1), WINDOW))
    assert once == rows(ev.cell_step_counts(held.orderBy(F.rand(5)).repartition(6), WINDOW))


def test_last_slot_registers_the_cell(spark):
    held = spans(spark, [("Event", "2018-06-03 04:50:00", "2018-06-03 04:55:00")])
    assert ev.registered_cells(held).count() == 1
    assert rows(ev.cell_step_counts(held, WINDOW), "step") == [(191,)]


def test_airports(spark):
    t = "2018-06-01 12:00:00"
    data = [("Event", t, t), ("Event", t, t, "X1", *AUSTIN), ("Event", t, t, "KAUS", 33.7, -84.4),
            ("Event", t, t, None, *AUSTIN), ("Event", t, t, "KATL", 33.7, -84.4)]
    held = spans(spark, data)
    for source in (held, ev.seen_places(held)):
        assert [a for _, a in rows(ev.cell_airports(source))] == ["KAUS", "KATL", "KAUS"] or \
            sorted(a for _, a in rows(ev.cell_airports(source))) == ["KATL", "KAUS", "KAUS"]
        # Atlanta comes after Austin in the list.
        assert rows(ev.airport_zones(source)) == [("KATL", "US/Eastern"), ("KAUS", "US/Eastern")]
