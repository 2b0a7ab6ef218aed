"""Irregular sensor observations brought onto the step grid."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import FLAG_COLUMNS, WEATHER_COLUMNS, WEATHER_MEASURES, GridWindow
from quartergrid.functions.clock import local_time, step_index
from quartergrid.functions.columns import computed_once
from quartergrid.functions.labels import tag_class

# Fixed value: measures at or below this are "no value" marks.
NO_VALUE = -1000.0

TAGS = ("conditions", "events")


def localise(observations: DataFrame, zones: DataFrame) -> DataFrame:
    """Local time of UTC observations; airports without a zone fall away."""
    zoned = observations.join(zones, "airport")
    return computed_once(zoned, ts_local=local_time(F.col("ts_utc"), F.col("zone")))


def wanted_airports(observations: DataFrame, zones: DataFrame) -> DataFrame:
    """Observations of the airports in use."""
    return observations.join(zones.select("airport"), "airport", "left_semi")


def airports_without_observations(observations: DataFrame, zones: DataFrame) -> DataFrame:
    """Airports in use of which :func:`wanted_airports` finds nothing."""
    return zones.select("airport").join(observations.select("airport").distinct(), "airport", "left_anti")


def first_per_step(observations: DataFrame, window: GridWindow) -> DataFrame:
    """The earliest observation of each (airport, step); ties go to ``obs_id``.

    Time and the whole number ``obs_id``, no two of which are equal, are folded into
    one number. Its minimum is a hash aggregate that is combined before the
    shuffle; one join then finds the rows that have it.
    """
    # Both signs of a long fit between two microseconds.
    folded = F.unix_micros("ts_local").cast("decimal(20,0)") * F.lit(Decimal(1 << 64)) + F.col("obs_id").cast("decimal(20,0)")
    stepped = observations.withColumn("step", step_index(F.col("ts_local"), window)).filter("step >= 0").select(
        "airport", "step", folded.cast("decimal(38,0)").alias("place"), *WEATHER_MEASURES, *TAGS)
    first = stepped.groupBy("airport", "step").agg(F.min("place").alias("place"))
    return stepped.join(first, ["airport", "step", "place"]).drop("place")


def fill_backward(observations: DataFrame, window: GridWindow) -> DataFrame:
    """Spans ``[from_step, to_step]`` each observation stands for.

    Step ``i`` takes the earliest observation of the first observed step at or
    after ``i``. There is no tolerance, and nothing after the last one.
    """
    by_airport = Window.partitionBy("airport").orderBy("step")
    before = F.lag("step", 1, -1).over(by_airport)
    last = F.lit(window.total_steps - 1)
    return (
        first_per_step(observations, window)
        .withColumn("from_step", before + 1)
        .withColumn("to_step", F.least("step", last))
        .filter("from_step <= to_step")
        .drop("step")
    )


def explode_fill(filled: DataFrame) -> DataFrame:
    """One row per filled step of a span table."""
    steps = F.explode(F.sequence("from_step", "to_step")).alias("step")
    rest = [c for c in filled.columns if c not in ("from_step", "to_step")]
    return filled.select(*rest, steps)


def tag_flags() -> list[Column]:
    """0/1 per flag: set when either tag of the observation is of its class."""
    return [
        F.greatest(
            *(F.when(tag_class(F.col(tag)) == flag, 1).otherwise(0) for tag in TAGS)
        ).alias(flag)
        for flag in FLAG_COLUMNS
    ]


def measured_spans(filled: DataFrame) -> DataFrame:
    """Spans with "no value" marks as null and tags folded to flags."""
    return filled.select(
        "airport", "from_step", "to_step",
        *(F.when(F.col(m) > NO_VALUE, F.col(m)).alias(w)
          for m, w in zip(WEATHER_MEASURES, WEATHER_COLUMNS)),
        *tag_flags(),
    )


def airport_sets(pairs: DataFrame) -> DataFrame:
    """(cell, airport_set): the sorted airports of a cell as one key.

    Neighbouring cells mostly see the same airports, so weather is averaged
    once per set, not once per cell. A set is as short as the list of airports
    that one 5 km cell reports to.
    """
    names = F.array_sort(F.collect_set("airport"))
    return pairs.groupBy("cell").agg(names.alias("airport_set"))


def set_weather(sets: DataFrame, spans: DataFrame, window: GridWindow) -> DataFrame:
    """(airport_set, step): mean measures and flags, 0 where nothing is known.

    Every step of the window is present for every set.
    """
    distinct = sets.select("airport_set").distinct().filter("airport_set is not null")
    members = distinct.withColumn("airport", F.explode("airport_set"))
    values = [*WEATHER_COLUMNS, *FLAG_COLUMNS]
    known = members.join(spans, "airport").select("airport_set", "from_step", "to_step", *values)
    frame = distinct.select(
        "airport_set",
        F.lit(0).cast("long").alias("from_step"),
        F.lit(window.total_steps - 1).cast("long").alias("to_step"),
        *(F.lit(None).cast("double").alias(c) for c in WEATHER_COLUMNS),
        *(F.lit(0).alias(c) for c in FLAG_COLUMNS),
    )
    return (
        explode_fill(known.unionByName(frame))
        .groupBy("airport_set", "step")
        .agg(
            *(F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in WEATHER_COLUMNS),
            *(F.max(c).alias(c) for c in FLAG_COLUMNS),
        )
    )


def cell_weather(sets: DataFrame, weather: DataFrame) -> DataFrame:
    """(cell, step) weather: the weather of the cell's airport set."""
    return sets.join(weather, "airport_set").drop("airport_set")
