"""The whole chain, from raw files to a scored model.

Each stage is a lazy DataFrame plan over all cities at once. ``run`` writes
the stage tables, so a stage that is read twice is computed once and a lost
executor never costs more than its own stage.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid import config
from quartergrid.operators import events as ev
from quartergrid.operators import examples as ex
from quartergrid.operators import features as ft
from quartergrid.operators import grid as gr
from quartergrid.operators import model as ml
from quartergrid.operators import nearest as nr
from quartergrid.operators import observations as ob
from quartergrid.operators import text_vectors as tv
from quartergrid.session import use_utc
from quartergrid.sources import readers, tables


@dataclass(frozen=True)
class Settings:
    """What to compute; the defaults are the published values."""

    cities: tuple[config.City, ...] = config.CITIES
    window: config.GridWindow = config.GRID_WINDOW
    grid_period: tuple[datetime, datetime] = config.GRID_EXTRACT
    text_period: tuple[datetime, datetime] = config.TEXT_EXTRACT
    precision: int = config.PRECISION
    text_dims: int = config.TEXT_DIMS
    keep_share: float = config.KEEP_SHARE
    lookback: int = config.LOOKBACK
    seed: int = 42


@dataclass(frozen=True)
class Inputs:
    """Paths of the raw inputs."""

    traffic: str
    weather: str
    daylight: str
    poi: str
    word_vectors: str


def extract(traffic: DataFrame, s: Settings, period: tuple[datetime, datetime]) -> DataFrame:
    """Events of the period with their city: one scan for all cities."""
    return ev.assign_cities(ev.in_period(traffic, *period), s.cities)


def extract_periods(traffic: DataFrame, s: Settings) -> DataFrame:
    """The events of both periods and those no period can take, in one scan.

    ``period`` is ``text``, ``grid`` (an event may be in both) or ``unreadable``,
    then ``reject`` says what of it can't be read.
    """
    def within(name: str, period: tuple[datetime, datetime]) -> Column:
        begin, stop = (F.lit(str(t)).cast("timestamp") for t in period)
        return F.when((F.col("start_utc") >= begin) & (F.col("start_utc") < stop), name)

    marked = traffic.withColumn("reject", ev.unreadable())
    bad = F.col("reject").isNotNull()
    periods = F.when(bad, F.array(F.lit("unreadable"))).otherwise(F.array_compact(F.array(
        within("text", s.text_period), within("grid", s.grid_period))))
    return ev.assign_cities(marked.withColumn("period", F.explode(periods)), s.cities, unplaced=bad)


def text_vectors(
    extracted: DataFrame, poi: DataFrame, vectors: DataFrame, s: Settings, stage: Callable[[str, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(cell, vec) from the descriptions of an extract; ``stage`` stores its texts and reads them back."""
    located = ev.locate(extracted, s.precision)
    return tv.cell_means(tv.only_known_cells(located, ft.usable_poi(poi)), vectors, s.text_dims, stage)


def event_spans(extracted: DataFrame, s: Settings) -> DataFrame:
    """Steps, class and cell of the usable events of an extract."""
    usable, _ = ev.split_unusable(extracted)
    return ev.locate(ev.keep_spans(ev.place_on_steps(usable, s.window)), s.precision).select(
        "city", "city_order", "zone", "cell", "airport", "class", "start_step", "stop_step"
    )


def airport_sets(seen: DataFrame, s: Settings) -> DataFrame:
    """(cell, airport_set) of every registered cell, own or borrowed.

    The set is null only where no cell at all has an airport.
    """
    cells = ev.registered_cells(seen).select("cell").distinct()
    pairs = nr.complete_airports(cells, ev.cell_airports(seen), s.precision)
    return cells.join(ob.airport_sets(pairs), "cell", "left")


def set_weather(sets: DataFrame, observations: DataFrame, s: Settings) -> DataFrame:
    """(airport_set, step) weather from observations in local time."""
    return ob.set_weather(sets, ob.measured_spans(ob.fill_backward(observations, s.window)), s.window)


def raw_grid(
    spans: DataFrame, sets: DataFrame, weather: DataFrame, daylight: DataFrame,
    codes: DataFrame, s: Settings, buckets: int | None = None,
) -> DataFrame:
    """Dense grid of an event-span table; carries the code of each cell."""
    return gr.dense_grid(
        ev.count_runs(spans, s.window), sets.join(codes, "cell", "left"), weather,
        gr.daylight_flags(daylight, s.cities, s.window), s.window, buckets,
    )


def city_models(examples: DataFrame, cities: tuple[config.City, ...]) -> DataFrame:
    """One row per listed city that has rows to train and to test on.

    (city, width, train_rows, test_rows, test_positives, accuracy, weighted_recall,
    weighted_f1). The models of all cities are fitted in the same passes over the
    examples; the driver holds their coefficients only.
    """
    listed = examples.filter(F.col("city").isin([c.name for c in cities]))
    is_test = F.col("split") == "test"
    counts = listed.groupBy("city").agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(is_test).alias("test_rows"),
        F.count_if(is_test & (F.col("label") > 0)).alias("test_positives"),
    ).filter("train_rows > 0 and test_rows > 0")
    models = ml.fit_groups(listed.filter("split = 'train'"), "city")
    widths = models.select("city", F.size("coefficients").cast("long").alias("width"))
    metrics = ml.class_metrics(ml.score_groups(models, listed.filter("split = 'test'"), "city"), "city")
    return widths.join(counts, "city").join(metrics, "city").select(
        "city", "width", "train_rows", "test_rows", "test_positives", "accuracy", "weighted_recall", "weighted_f1")


def run(spark: SparkSession, inputs: Inputs, out: str, s: Settings = Settings()) -> dict[str, str]:
    """Write all stage tables below ``out``; returns their paths by name."""
    use_utc(spark)
    paths = {}

    def stage(name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        paths[name] = tables.save(df, f"{out}/{name}", *partition_by)
        return tables.load(spark, paths[name])

    poi, poi_copies = readers.collapse_copies(readers.read_poi(spark, inputs.poi), "cell")
    poi = stage("poi", poi)
    stage("reject_poi", ft.unusable_poi(poi))
    stage("copies_poi", poi_copies)
    vectors, bad_vectors = readers.split_word_vectors(
        readers.read_word_vectors(spark, inputs.word_vectors), s.text_dims
    )
    vectors, vector_copies = readers.collapse_copies(vectors, "word")
    vectors = stage("word_vectors", vectors)
    stage("reject_word_vectors", bad_vectors)
    stage("copies_word_vectors", vector_copies)

    traffic = readers.read_traffic(spark, inputs.traffic)
    extracts = stage("extract", extract_periods(traffic, s), "period", "city")
    for_text = extracts.filter("period = 'text'").drop("period", "reject")
    cell_text = stage("cell_text", text_vectors(for_text, poi, vectors, s, stage))

    for_grid = extracts.filter("period = 'grid'").drop("period", "reject")
    unusable = ev.split_unusable(for_grid)[1]
    stage("reject_traffic", unusable.unionByName(extracts.filter("period = 'unreadable'").drop("period")))
    spans = stage("spans", event_spans(for_grid, s), "city")
    seen = stage("seen", ev.seen_places(spans))
    cells = ev.registered_cells(seen)
    stage("reject_cells", ft.cells_without_poi(cells, poi))
    sets = stage("airport_sets", airport_sets(seen, s))

    zones = stage("airports", ev.airport_zones(seen))
    text = ob.wanted_airports(readers.read_observations(spark, inputs.weather), zones)
    state = F.when(F.col("reject").isNull(), "good").otherwise("bad")
    parsed = stage("observations", readers.parse_observations(text).withColumn("state", state), "state")
    stage("reject_weather", parsed.filter("state = 'bad'").drop("state"))
    stage("reject_airports", ob.airports_without_observations(parsed, zones))
    weather = stage("weather", set_weather(sets, parsed.filter("state = 'good'"), s))

    daylight, daylight_copies = readers.collapse_copies(
        readers.read_daylight(spark, inputs.daylight), "place", "day"
    )
    daylight = stage("daylight", daylight)
    stage("copies_daylight", daylight_copies)
    stage("reject_places", gr.places_without_daylight(daylight, s.cities))
    stage("reject_days", gr.days_without_daylight(daylight, s.cities, s.window))

    codes = stage("cell_codes", ft.cell_codes(ft.usable_poi(poi), s.precision))
    # Look-back and features go by cell, so the grid is dealt out that way while it is
    # still runs of steps, and stored in buckets.
    buckets = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def bucketed(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{out}/{name}"
        return spark.table(tables.save_bucketed(df, paths[name], "cell", buckets, ("cell", "step"), "city"))

    grid = bucketed("grid", raw_grid(spans, sets, weather, daylight, codes, s, buckets))
    clean = bucketed("grid_clean", gr.clean_grid(grid))
    per_cell = stage("cell_features", ft.cell_features(cells, poi, cell_text, s.text_dims, s.precision))
    stage("examples", training_examples(clean, per_cell, s, stage, dealt=True), "city", "split")
    return paths


def training_examples(
    clean: DataFrame, per_cell: DataFrame, s: Settings, stage: Callable[..., DataFrame], dealt: bool = False,
) -> DataFrame:
    """Sampled examples; ``stage`` stores a small table and reads it back.

    ``dealt`` says that ``clean`` is dealt out by cell. One pass over it tells where
    cities end and the ranges of their columns, another where accidents are.
    """
    extremes = stage("step_extremes", ex.step_extremes(clean))
    ends = ex.last_steps(extremes)
    ranges = ex.train_ranges(ex.chrono_split(extremes, ends))
    positives = stage("positives", clean.filter("predicted_accident > 0").select("cell", "step"))
    return ex.training_examples(
        clean, per_cell, s.seed, s.keep_share, s.lookback, ends, ranges, positives, dealt)
