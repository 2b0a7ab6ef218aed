"""From traffic events to sparse counts per place and step."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import PRECISION, TRAFFIC_COLUMNS, City, GridWindow, city_table
from quartergrid.functions.clock import local_time, step_index
from quartergrid.functions.columns import computed_once
from quartergrid.functions.geohash import cell_of
from quartergrid.functions.labels import class_indicators, event_class


def in_period(events: DataFrame, start: datetime, finish: datetime) -> DataFrame:
    """Events starting in the half-open UTC period."""
    begin, stop = (F.lit(str(t)).cast("timestamp") for t in (start, finish))
    return events.filter((F.col("start_utc") >= begin) & (F.col("start_utc") < stop))


# Tiles per degree: a tile of a tenth of a degree is a part of a city.
TILES = 10


def assign_cities(
    events: DataFrame, cities: tuple[City, ...], unplaced: Column | None = None
) -> DataFrame:
    """Give each event the cities whose open box holds its point.

    The boxes are laid over tiles, so this is an equality join on the tile with
    the box test on top. Spark knows the size of the tiled boxes: it broadcasts
    them and leaves the events where they are, or shuffles both by tile.
    Events in no city are dropped, but for those that ``unplaced`` holds for.
    """
    def tiles(low: str, high: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(low) * TILES), F.floor(F.col(high) * TILES)))

    boxes = (
        city_table(events.sparkSession, cities)
        .withColumn("tile_lat", tiles("lat_min", "lat_max"))
        .withColumn("tile_lng", tiles("lng_min", "lng_max"))
    )
    inside = (
        (F.floor(F.col("lat") * TILES) == F.col("tile_lat"))
        & (F.floor(F.col("lng") * TILES) == F.col("tile_lng"))
        & (F.col("lat") > F.col("lat_min")) & (F.col("lat") < F.col("lat_max"))
        & (F.col("lng") > F.col("lng_min")) & (F.col("lng") < F.col("lng_max"))
    )
    joined = events.join(boxes, inside, "inner" if unplaced is None else "left").select(
        *events.columns, "city", "city_order", "zone", "state"
    )
    return joined if unplaced is None else joined.filter(F.col("city").isNotNull() | unplaced)


def unreadable() -> Column:
    """Why an event can have no place on the grid at all: null when it can."""
    return F.when(F.col("start_utc").isNull(), "start").when(
        F.col("lat").isNull() | F.col("lng").isNull(), "point"
    )


def split_unusable(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events with an end and a type, the others with the reason)."""
    reason = F.when(F.col("end_utc").isNull(), "end").when(F.col("type").isNull(), "type")
    marked = events.withColumn("reject", reason)
    return marked.filter("reject is null").drop("reject"), marked.filter("reject is not null")


def locate(events: DataFrame, precision: int = PRECISION) -> DataFrame:
    """Add the geohash cell of each event."""
    return computed_once(events, cell=cell_of(F.col("lat"), F.col("lng"), precision))


def place_on_steps(events: DataFrame, window: GridWindow) -> DataFrame:
    """Add ``start_step`` and ``end_step`` in local time.

    Events starting outside the window are dropped; an end outside it is moved
    to the last step.
    """
    localised = computed_once(
        events,
        start_local=local_time(F.col("start_utc"), F.col("zone")),
        end_local=local_time(F.col("end_utc"), F.col("zone")),
    )
    end = step_index(F.col("end_local"), window)
    last = F.lit(window.total_steps - 1).cast("long")
    return (
        localised.withColumn("start_step", step_index(F.col("start_local"), window))
        .filter(F.col("start_step") >= 0)
        .withColumn("end_step", F.when(end == -1, last).otherwise(end))
    )


def keep_spans(events: DataFrame) -> DataFrame:
    """Add ``class`` and ``stop_step`` (exclusive); drop empty spans.

    An accident holds its first step only, other events all of theirs. An end
    before the start leaves nothing, unless the event is an accident.
    """
    cls = event_class(F.col("type"))
    stop = F.when(cls == "Accident", F.col("start_step") + 1).otherwise(F.col("end_step") + 1)
    return (
        events.withColumn("class", cls)
        .withColumn("stop_step", stop)
        .filter(F.col("stop_step") > F.col("start_step"))
    )


def explode_spans(spans: DataFrame) -> DataFrame:
    """One row per event and step it holds."""
    steps = F.sequence(F.col("start_step"), F.col("stop_step") - 1)
    return spans.withColumn("step", F.explode(steps))


def prepare_spans(
    events: DataFrame, cities: tuple[City, ...], start: datetime, finish: datetime,
    window: GridWindow, precision: int = PRECISION,
) -> DataFrame:
    """Period, city, cell, steps and class of every usable event: no shuffle."""
    usable, _ = split_unusable(assign_cities(in_period(events, start, finish), cities))
    return locate(keep_spans(place_on_steps(usable, window)), precision)


def count_changes(spans: DataFrame) -> DataFrame:
    """Changes of the event counts per (city, cell, step).

    Each event adds its indicators where it starts and takes them away where
    it stops: two rows, however long it is. Sums are combined before the
    shuffle, so a cell holding a third of all events still sends at most one
    row per step and task.
    """
    marks = class_indicators(F.col("class"))
    points = F.array(
        F.struct(F.col("start_step").alias("step"), F.lit(1).alias("sign")),
        F.struct(F.col("stop_step").alias("step"), F.lit(-1).alias("sign")),
    )
    return (
        spans.select("city", "cell", *(marks[c].alias(c) for c in TRAFFIC_COLUMNS),
                     F.inline(points))
        .groupBy("city", "cell", "step")
        .agg(
            *(F.sum(F.col(c) * F.col("sign")).alias(c) for c in TRAFFIC_COLUMNS),
            F.sum("sign").alias("events"),
        )
    )


def count_runs(spans: DataFrame, window: GridWindow) -> DataFrame:
    """Runs ``[step, next_step)`` of constant counts, gap-free from step 0.

    ``next_accidents`` is the accident count of the following run. A cell has
    at most one run per step, so its window is bounded.
    """
    by_cell = Window.partitionBy("city", "cell").orderBy("step")
    so_far = by_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (*TRAFFIC_COLUMNS, "events")
    # By cell alone: serves this window and later joins on the cell.
    running = count_changes(spans).repartition("cell").select(
        "city", "cell", "step", *(F.sum(c).over(so_far).alias(c) for c in counts)
    )
    # Beyond the grid steps there is at most the slot that only registers.
    following = running.select(
        "*",
        F.lead("step", 1, window.total_steps + 1).over(by_cell).alias("next_step"),
        F.lead("t_accident", 1, 0).over(by_cell).alias("next_accidents"),
        F.row_number().over(by_cell).alias("nth"),
    )
    zero = F.lit(0).cast("long")
    run = F.struct("step", *counts, "next_step", "next_accidents")
    empty_start = F.struct(
        zero.alias("step"), *(zero.alias(c) for c in counts),
        F.col("step").alias("next_step"), F.col("t_accident").alias("next_accidents"),
    )
    opens = (F.col("nth") == 1) & (F.col("step") > 0)
    return following.select(
        "city", "cell", F.inline(F.when(opens, F.array(empty_start, run)).otherwise(F.array(run)))
    )


def cell_step_counts(spans: DataFrame, window: GridWindow) -> DataFrame:
    """Sums of the 8 indicators per (city, cell, step) that holds any event."""
    held = count_runs(spans, window).filter("events > 0")
    return held.withColumn(
        "step", F.explode(F.sequence(F.col("step"), F.col("next_step") - 1))
    ).select("city", "cell", "step", *TRAFFIC_COLUMNS)


def seen_places(spans: DataFrame) -> DataFrame:
    """Distinct (city, cell, airport) with the order and zone of the city.

    Cells, their airports and the zones of airports all follow from this small
    table: write it once and the events are not read again for them.
    """
    return spans.select("city", "city_order", "zone", "cell", "airport").distinct()


def cell_airports(spans: DataFrame) -> DataFrame:
    """Distinct (cell, airport); codes of three letters or fewer are invalid."""
    return spans.filter(F.length("airport") > 3).select("cell", "airport").distinct()


def airport_zones(spans: DataFrame) -> DataFrame:
    """Time zone of each airport: that of the last listed city using it."""
    return (
        spans.filter(F.length("airport") > 3)
        .groupBy("airport")
        .agg(F.max(F.struct("city_order", "zone")).alias("last"))
        .select("airport", F.col("last.zone").alias("zone"))
    )


def registered_cells(spans: DataFrame) -> DataFrame:
    """Distinct (city, cell) with any event in the window."""
    return spans.select("city", "cell").distinct()
