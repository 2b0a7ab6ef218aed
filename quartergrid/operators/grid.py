"""The dense place x step grid and its labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import (
    CLEAN_GRID_COLUMNS, FLAG_COLUMNS, RAW_GRID_COLUMNS, TRAFFIC_COLUMNS, WEATHER_COLUMNS, City,
    GridWindow, city_table,
)
from quartergrid.functions.clock import hour_class, step_time, weekday_flag
from quartergrid.functions.labels import positive


def calendar(df: DataFrame, window: GridWindow) -> DataFrame:
    """Add day of week (Monday 0) and hour of each step."""
    at = step_time(F.col("step"), window)
    return df.withColumn("dow", F.weekday(at)).withColumn("hod", F.hour(at))


def daylight_flags(
    daylight: DataFrame, cities: tuple[City, ...], window: GridWindow
) -> DataFrame:
    """(city, step, daylight): 1 from sunrise to sunset, both included.

    A day or city that is not in the table is dark.
    """
    at = step_time(F.col("step"), window)
    steps = (
        city_table(daylight.sparkSession, cities)
        .select("city", F.concat_ws("-", "city", "state").alias("place"))
        .withColumn("step", F.explode(F.sequence(
            F.lit(0).cast("long"), F.lit(window.total_steps - 1).cast("long"))))
        .withColumn("day", F.to_date(at))
    )
    second = F.unix_seconds(at) % 86400
    lit = second.between(F.col("sunrise") * 60, F.col("sunset") * 60)
    return steps.join(daylight, ["place", "day"], "left").select(
        "city", "step", F.when(lit, 1).otherwise(0).alias("daylight")
    )


def places_without_daylight(daylight: DataFrame, cities: tuple[City, ...]) -> DataFrame:
    """Cities the daylight table does not know."""
    places = city_table(daylight.sparkSession, cities).select(
        "city", F.concat_ws("-", "city", "state").alias("place")
    )
    return places.join(daylight, "place", "left_anti")


def days_without_daylight(
    daylight: DataFrame, cities: tuple[City, ...], window: GridWindow
) -> DataFrame:
    """(city, day) of the window that the daylight table lacks; they are dark."""
    days = F.explode(F.sequence(F.to_date(F.lit(window.begin_text)), F.to_date(F.lit(window.end_text))))
    wanted = city_table(daylight.sparkSession, cities).select(
        "city", F.concat_ws("-", "city", "state").alias("place"), days.alias("day")
    )
    return wanted.join(daylight.select("place", "day"), ["place", "day"], "left_anti").select("city", "day")


def in_blocks(per_step: DataFrame, key: str, window: GridWindow) -> DataFrame:
    """(key, block) with the rows of a block as an array, one place per step.

    A block is ``window.block_steps`` steps, so the arrays are short. Steps that
    the table lacks are null in it.
    """
    values = [c for c in per_step.columns if c not in (key, "step")]
    size = window.block_steps
    place = (F.col("step") % size).cast("int")
    held = (
        per_step.withColumn("block", F.floor(F.col("step") / size))
        .groupBy(key, "block")
        .agg(F.map_from_entries(F.collect_list(F.struct(place, F.struct(*values)))).alias("held"))
    )
    places = F.sequence(F.lit(0), F.lit(size - 1))
    rows = F.transform(places, lambda i: F.try_element_at("held", i)).alias(f"{key}_rows")
    return held.select(key, "block", rows)


# Blocks of one cell that a task stretches into steps at most: about 100,000 rows.
BLOCKS_PER_TASK = 1000


def stretch_tasks(blocks: int, slots: int) -> int:
    """In how many tasks to stretch so many blocks, where ``slots`` run at a time.

    All slots have work, in waves of equal tasks, and no task has more than
    BLOCKS_PER_TASK blocks unless the keys fall unevenly.
    """
    waves = -(-blocks // (slots * BLOCKS_PER_TASK))
    return max(1, min(blocks, waves * slots))


def dense_grid(
    runs: DataFrame, places: DataFrame, weather: DataFrame, daylight: DataFrame, window: GridWindow,
    buckets: int | None = None,
) -> DataFrame:
    """One row per registered cell and step, gaps as 0.

    ``runs`` already cover every step of a cell, so the grid comes from
    stretching them; nothing of grid size is joined or shuffled. Weather and
    daylight are joined as blocks of steps and read by position after the
    stretch. ``next_accidents`` is the accident count of the following step,
    null at the last one. ``places`` is (cell, airport_set) and any further
    columns per cell, which are carried into the grid; a stored table, as its
    rows are counted to say in how many tasks the grid is made. With ``buckets`` the
    runs are dealt out by cell into so many tasks instead, for a bucketed table.
    """
    carried = [c for c in places.columns if c not in ("cell", "airport_set")]
    total, size = window.total_steps, window.block_steps
    light = in_blocks(daylight, "city", window)
    if buckets is None:
        slots = places.sparkSession.sparkContext.defaultParallelism
        deal = (stretch_tasks(places.count() * -(-total // size), slots), "cell", "block")
    else:
        deal = (buckets, "cell")
    stop = F.least(F.col("next_step"), F.lit(total))
    pieces = (
        runs.filter(F.col("step") < total)
        .join(places, "cell", "left")
        .withColumn("stop", stop)
        .withColumn("block", F.explode(F.sequence(
            F.floor(F.col("step") / size), F.floor((F.col("stop") - 1) / size))))
        .withColumn("lo", F.greatest(F.col("step"), F.col("block") * size))
        .withColumn("hi", F.least(F.col("stop"), (F.col("block") + 1) * size))
        .drop("step", "stop")
        .join(in_blocks(weather, "airport_set", window), ["airport_set", "block"], "left")
        .join(light, ["city", "block"], "left")
        # The runs are few bytes and would be stretched in few tasks.
        .repartition(*deal)
        .withColumn("step", F.explode(F.sequence(F.col("lo"), F.col("hi") - 1)))
    )
    at = (F.col("step") - F.col("block") * size).cast("int")
    sky = F.get(F.col("airport_set_rows"), at)
    following = (
        F.when(F.col("step") + 1 >= total, F.lit(None))
        .when(F.col("step") + 1 < F.col("next_step"), F.col("t_accident"))
        .otherwise(F.col("next_accidents"))
    )
    filled = pieces.select(
        "city", "cell", "step",
        F.coalesce(F.get(F.col("city_rows"), at)["daylight"], F.lit(0)).alias("daylight"),
        *TRAFFIC_COLUMNS,
        *(F.coalesce(sky[c], F.lit(0.0)).alias(c) for c in WEATHER_COLUMNS),
        *(F.coalesce(sky[c], F.lit(0)).alias(c) for c in FLAG_COLUMNS),
        following.alias("next_accidents"),
        *carried,
    )
    return calendar(filled, window).select("city", *RAW_GRID_COLUMNS, "next_accidents", *carried)


def next_step_label(grid: DataFrame) -> DataFrame:
    """Binary accident flag and, as label, the flag of the next step.

    The last step of a cell has no label and is dropped. A grid that carries
    ``next_accidents`` needs no window; any other is ordered per cell.
    """
    flagged = grid.withColumn("t_accident", positive(F.col("t_accident")))
    if "next_accidents" in grid.columns:
        labelled = flagged.withColumn(
            "predicted_accident",
            F.when(F.col("next_accidents").isNotNull(), positive(F.col("next_accidents"))),
        ).drop("next_accidents")
    else:
        by_cell = Window.partitionBy("city", "cell").orderBy("step")
        labelled = flagged.withColumn("predicted_accident", F.lead("t_accident", 1).over(by_cell))
    return labelled.dropna(subset=["predicted_accident"])


def day_classes(grid: DataFrame) -> DataFrame:
    """Add the weekday flag and the part of the day."""
    return grid.withColumn("dow_cat", weekday_flag(F.col("dow"))).withColumn(
        "hod_cat", hour_class(F.col("hod"))
    )


def clean_grid(grid: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Labelled grid in its final column order; cells without a code drop out.

    Best given a grid that carries ``cell_code``, as the code is then joined
    per cell and not per step. Otherwise ``codes`` is joined here.
    """
    coded = grid if codes is None else grid.join(codes, "cell")
    rows = day_classes(next_step_label(coded.filter("cell_code is not null")))
    return rows.select("city", *CLEAN_GRID_COLUMNS)
