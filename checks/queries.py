
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import standins as si
from quartergrid.config import (
    CLEAN_GRID_COLUMNS, FLAG_COLUMNS, POI_FIELDS, RAW_GRID_COLUMNS, SCALED_COLUMNS, TRAFFIC_COLUMNS,
    WEATHER_COLUMNS, WEATHER_MEASURES,
)
from quartergrid.functions import clock, labels
from quartergrid.functions.text import number_array, tokens
from quartergrid.operators import events as ev
from quartergrid.operators import examples as ex
from quartergrid.operators import features as ft
from quartergrid.operators import grid as gr
from quartergrid.operators import model as ml
from quartergrid.operators import nearest as nr
from quartergrid.operators import observations as ob
from quartergrid.operators import text_vectors as tv
from quartergrid.plans import pipeline as pl
from quartergrid.session import shared_folder
from quartergrid.sources import readers, tables

S = si.SETTINGS
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """The table written out and read back, as the pipeline does per stage."""
    return tables.load(spark, tables.save(df, scratch(spark, name), *partition_by))


def r6(value: Column) -> Column:
    """Six decimals; adding zero turns -0.0 into 0.0."""
    return F.round(value, 6) + F.lit(0.0)


def micros(name: str) -> Column:
    return F.unix_micros(name)


def long_form(df: DataFrame, key: str, array: str) -> DataFrame:
    """(key, pos, value) of an array column."""
    return df.select(key, F.posexplode(array).alias("pos", "raw")).select(
        key, F.col("pos").cast("long").alias("pos"), r6(F.col("raw")).alias("value")
    )


def checksum(array: str) -> Column:
    """Sum of value times position (from 1): sees values and their order."""
    weighted = F.transform(array, lambda x, i: x * (i + 1))
    return F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)


# --- shared inputs ---------------------------------------------------------

def extracted(spark, sf_dir):
    return pl.extract(si.traffic(spark, sf_dir), S, S.grid_period)


def placed(spark, sf_dir):
    return ev.place_on_steps(extracted(spark, sf_dir), S.window)


def spans(spark, sf_dir):
    return pl.event_spans(extracted(spark, sf_dir), S)


def seen(spark, sf_dir):
    return staged(spark, ev.seen_places(spans(spark, sf_dir)), "seen")


def local_observations(spark, sf_dir, seen_table):
    return ob.localise(si.observations_utc(spark, sf_dir), ev.airport_zones(seen_table))


def set_weather(spark, sf_dir, seen_table):
    sets = staged(spark, pl.airport_sets(seen_table, S), "sets")
    obs = local_observations(spark, sf_dir, seen_table)
    return sets, pl.set_weather(sets, obs, S)


def daylight(spark, sf_dir):
    text = si.daylight_text(spark, sf_dir)
    return text.select(
        "place",
        F.to_date(F.try_to_timestamp("day", F.lit("yyyy-M-d"))).alias("day"),
        clock.clock_minutes(F.col("sunrise")).alias("sunrise"),
        clock.clock_minutes(F.col("sunset")).alias("sunset"),
    )


def raw_grid(spark, sf_dir):
    held = staged(spark, spans(spark, sf_dir), "spans", "city")
    places = staged(spark, ev.seen_places(held), "seen")
    sets, weather = set_weather(spark, sf_dir, places)
    codes = staged(spark, ft.cell_codes(ft.usable_poi(si.poi(spark, sf_dir))), "codes")
    weather, light = staged(spark, weather, "weather"), staged(spark, daylight(spark, sf_dir), "daylight")
    return pl.raw_grid(held, sets, weather, light, codes, S)


def clean_grid(spark, sf_dir):
    return gr.clean_grid(raw_grid(spark, sf_dir))


def examples(spark, sf_dir):
    clean = staged(spark, clean_grid(spark, sf_dir), "clean", "city")
    poi = staged(spark, si.poi(spark, sf_dir), "poi")
    text = staged(spark, cell_vectors(spark, sf_dir), "cell_text")
    per_cell = staged(spark, ft.cell_features(clean.select("cell"), poi, text, si.DIMS), "cell_features")
    return pl.training_examples(clean, per_cell, S, lambda name, df: staged(spark, df, name))


# --- scans and sinks -------------------------------------------------------

@query
def scan_events(spark, sf_dir):
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    source = si.traffic(spark, sf_dir)
    text = {"start_utc": F.date_format("start_utc", stamp), "end_utc": F.date_format("end_utc", stamp)}
    path = scratch(spark, "traffic")
    source.select(
        *(text.get(new, F.col(new)).alias(old) for old, new in readers.TRAFFIC_FIELDS.items())
    ).write.option("header", True).csv(path)
    return readers.read_traffic(spark, path).select(
        micros("start_utc").alias("start_us"), micros("end_utc").alias("end_us"),
        "lat", "lng", "airport", "type", "description",
    )


@query
def sink_roundtrip_extract(spark, sf_dir):
    stored = staged(spark, extracted(spark, sf_dir), "extract", "city")
    return stored.select("city", "event_id", micros("start_utc").alias("start_us"), "type")


@query
def scan_word_vectors(spark, sf_dir):
    source = si.word_vectors(spark, sf_dir)
    path = scratch(spark, "words")
    numbers = F.array_join(F.transform("vec", lambda v: v.cast("string")), " ")
    source.select(F.concat_ws(" ", "word", numbers).alias("value")).write.text(path)
    good, _ = readers.split_word_vectors(readers.read_word_vectors(spark, path), si.DIMS)
    read, _ = readers.collapse_copies(good, "word")
    return read.select(
        "word", F.size("vec").cast("long").alias("dims"), r6(checksum("vec")).alias("checksum")
    )


@query
def scan_poi(spark, sf_dir):
    # The same rows once more, and rows with a smaller first count: both give way.
    path, source = scratch(spark, "poi"), si.poi(spark, sf_dir)
    lesser = source.withColumn(POI_FIELDS[0], F.col(POI_FIELDS[0]) - 1)
    source.unionByName(source).unionByName(lesser).withColumnRenamed("cell", "Geohash").write.option(
        "header", True).csv(path)
    read, _ = readers.collapse_copies(readers.read_poi(spark, path), "cell")
    return read.select("cell", *(F.col(c).cast("long").alias(c.lower()) for c in POI_FIELDS))


@query
def scan_weather(spark, sf_dir):
    """One file per airport, all of its columns."""
    folder = scratch(spark, "weather")
    source = si.observation_text(spark, sf_dir).drop("obs_id")
    source.write.partitionBy("airport").option("header", True).csv(folder)
    read = readers.read_observations(spark, folder)
    zones = ev.airport_zones(spans(spark, sf_dir))
    names = {
        "Date": "obs_date", "Hour": "obs_hour", "Temp": "temp", "WindChill": "wind_chill", "Humd": "humidity",
        "Pressure": "pressure", "Visib": "visibility", "WindSpeed": "wind_speed", "Precipitation": "precipitation",
        "events": "events_tag", "conditions": "conditions_tag",
    }
    return ob.wanted_airports(read, zones).select(
        "airport", *(F.col(old).alias(new) for old, new in names.items()))


@query
def scan_daylight(spark, sf_dir):
    path = scratch(spark, "daylight")
    # The same rows once more, and rows with an earlier sunrise: both give way.
    source = si.daylight_text(spark, sf_dir)
    earlier = source.withColumn("sunrise", F.lit("6:00 am"))
    source.unionByName(source).unionByName(earlier).write.csv(path)
    read, _ = readers.collapse_copies(readers.read_daylight(spark, path), "place", "day")
    return read.select(
        "place", F.date_format("day", "yyyy-MM-dd").alias("day"),
        F.col("sunrise").cast("long").alias("sunrise"), F.col("sunset").cast("long").alias("sunset"),
    )


@query
def sink_roundtrip_vectors(spark, sf_dir):
    path = tables.save_vectors_csv(cell_vectors(spark, sf_dir), scratch(spark, "vectors"))
    return long_form(tables.load_vectors_csv(spark, path), "cell", "vec")


@query
def sink_roundtrip_grid(spark, sf_dir):
    path = tables.save_grid_csv(raw_grid(spark, sf_dir), scratch(spark, "grid"))
    read = tables.load_grid_csv(spark, path)
    return read.select("city", *whole_and_rounded(read, RAW_GRID_COLUMNS))


@query
def sink_roundtrip_clean_grid(spark, sf_dir):
    path = tables.save_grid_csv(clean_grid(spark, sf_dir), scratch(spark, "clean"), clean=True)
    read = tables.load_grid_csv(spark, path, clean=True)
    return read.select("city", *whole_and_rounded(read, CLEAN_GRID_COLUMNS))


@query
def sink_roundtrip_trainset(spark, sf_dir):
    stored = staged(spark, examples(spark, sf_dir), "examples", "city", "split")
    return stored.groupBy("city", "split", F.col("label").cast("long").alias("label")).agg(
        F.count(F.lit(1)).alias("n_examples"), F.max(F.size("feature")).cast("long").alias("width")
    )


# --- projections and filters ----------------------------------------------

@query
def bbox_time_filter(spark, sf_dir):
    return extracted(spark, sf_dir).select("event_id", "city")


@query
def city_range_join(spark, sf_dir):
    return ev.assign_cities(si.traffic(spark, sf_dir), S.cities).select("event_id", "city", "zone")


@query
def geohash_cell(spark, sf_dir):
    return ev.locate(si.traffic(spark, sf_dir)).select("event_id", "cell")


@query
def valid_cell_semi_join(spark, sf_dir):
    located = ev.locate(si.traffic(spark, sf_dir))
    return tv.only_known_cells(located, ft.usable_poi(si.poi(spark, sf_dir))).select(
        "event_id", "cell"
    )


@query
def event_type_normalize(spark, sf_dir):
    return si.traffic(spark, sf_dir).select(
        "event_id", "type", labels.event_class(F.col("type")).alias("event_class")
    )


@query
def local_time(spark, sf_dir):
    return ev.assign_cities(si.traffic(spark, sf_dir), S.cities).select(
        "event_id", "city",
        F.unix_micros(clock.local_time(F.col("start_utc"), F.col("zone"))).alias("start_local_us"),
        F.unix_micros(clock.local_time(F.col("end_utc"), F.col("zone"))).alias("end_local_us"),
    )


@query
def interval_index(spark, sf_dir):
    events = ev.assign_cities(si.traffic(spark, sf_dir), S.cities)
    return events.select("event_id", "city", *(
        clock.step_index(clock.local_time(F.col(f"{side}_utc"), F.col("zone")), S.window)
        .alias(f"{side}_step") for side in ("start", "end")
    ))


@query
def interval_clamp(spark, sf_dir):
    return placed(spark, sf_dir).select("event_id", "city", "start_step", "end_step")


@query
def span_explode(spark, sf_dir):
    held = ev.keep_spans(placed(spark, sf_dir))
    return ev.explode_spans(held).select("event_id", "city", "step")


@query
def calendar_features(spark, sf_dir):
    steps = placed(spark, sf_dir).select("event_id", F.col("start_step").alias("step"))
    return gr.day_classes(gr.calendar(steps, S.window)).select(
        "event_id", "step", *(F.col(c).cast("long").alias(c) for c in ("dow", "hod", "dow_cat", "hod_cat"))
    )


@query
def hour_onehot(spark, sf_dir):
    steps = placed(spark, sf_dir).select("event_id", F.col("start_step").alias("step"))
    return ex.encode_hours(gr.day_classes(gr.calendar(steps, S.window))).select(
        "event_id", *(f"hod_en{i}" for i in range(5))
    )


@query
def weather_parse_reject(spark, sf_dir):
    parsed = readers.parse_observations(si.observation_text(spark, sf_dir))
    return parsed.select(
        "obs_id", "airport", "reject",
        F.date_format("ts_local", "yyyy-MM-dd HH:mm").alias("local_minute"),
        *(r6(F.col(c)).alias(c) for c in readers.OBSERVATION_FIELDS.values()),
    )


@query
def tokenize(spark, sf_dir):
    words = tokens(F.col("text"))
    return si.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(words).cast("long").alias("n_tokens"),
        F.md5(F.array_join(words, "|")).alias("digest"),
    )


@query
def vector_parse(spark, sf_dir):
    text = F.array_join(
        F.transform("embedding", lambda v: v.cast("double").cast("string")), " "
    )
    vectors = si.table(spark, sf_dir, "embeddings").select("vec_id", text.alias("vec"))
    return long_form(vectors.withColumn("vec", number_array(F.col("vec"))), "vec_id", "vec")


# --- aggregations and joins ------------------------------------------------

@query
def cell_step_counts(spark, sf_dir):
    counts = ev.cell_step_counts(spans(spark, sf_dir), S.window)
    return counts.select("city", "cell", "step", *(F.col(c).cast("long").alias(c) for c in TRAFFIC_COLUMNS))


@query
def cell_airports(spark, sf_dir):
    return ev.cell_airports(spans(spark, sf_dir))


@query
def airport_zone(spark, sf_dir):
    return ev.airport_zones(spans(spark, sf_dir))


@query
def nearest_cell_airports(spark, sf_dir):
    places = seen(spark, sf_dir)
    return nr.complete_airports(ev.registered_cells(places), ev.cell_airports(places))


@query
def next_obs_fill(spark, sf_dir):
    obs = local_observations(spark, sf_dir, seen(spark, sf_dir))
    return ob.explode_fill(ob.fill_backward(obs, S.window)).select(
        "airport", "step", *(r6(F.col(m)).alias(m) for m in WEATHER_MEASURES),
        F.col("conditions").alias("conditions_tag"), F.col("events").alias("events_tag"),
    )


def weather_of_cells(spark, sf_dir):
    return ob.cell_weather(*set_weather(spark, sf_dir, seen(spark, sf_dir)))


@query
def weather_cell_mean(spark, sf_dir):
    return weather_of_cells(spark, sf_dir).select(
        "cell", "step", *(r6(F.col(c)).alias(c) for c in WEATHER_COLUMNS)
    )


@query
def weather_flags(spark, sf_dir):
    return weather_of_cells(spark, sf_dir).select(
        "cell", "step", *(F.col(c).cast("long").alias(c) for c in FLAG_COLUMNS)
    )


@query
def daylight_flag(spark, sf_dir):
    return gr.daylight_flags(daylight(spark, sf_dir), S.cities, S.window).select(
        "city", "step", F.col("daylight").cast("long").alias("daylight")
    )


def whole_and_rounded(grid: DataFrame, columns) -> list[Column]:
    kinds = dict(grid.dtypes)
    return [
        F.col(c) if kinds[c] == "string"
        else (r6(F.col(c)) if kinds[c] == "double" else F.col(c).cast("long")).alias(c)
        for c in columns
    ]


@query
def dense_grid(spark, sf_dir):
    grid = raw_grid(spark, sf_dir)
    return grid.select("city", *whole_and_rounded(grid, RAW_GRID_COLUMNS))


@query
def next_step_label(spark, sf_dir):
    grid = raw_grid(spark, sf_dir).select("city", "cell", "step", "t_accident")
    return gr.next_step_label(grid).select(
        "city", "cell", "step", F.col("t_accident").cast("long").alias("t_accident"),
        F.col("predicted_accident").cast("long").alias("predicted_accident"),
    )


@query
def grid_project(spark, sf_dir):
    grid = clean_grid(spark, sf_dir)
    return grid.select(*whole_and_rounded(grid, grid.columns))


@query
def token_vector_join(spark, sf_dir):
    documents = si.documents(spark, sf_dir)
    joined = tv.token_vectors(documents, si.word_vectors(spark, sf_dir), "doc_id", "text")
    return joined.select(
        "doc_id", "word", "uses",
        r6(F.get("vec", F.lit(0))).alias("v_first"), r6(F.get("vec", F.lit(si.DIMS - 1))).alias("v_last"),
    )


@query
def doc_vector_mean(spark, sf_dir):
    documents = si.documents(spark, sf_dir)
    means = tv.text_means(documents, si.word_vectors(spark, sf_dir), "doc_id", "text", si.DIMS)
    return long_form(means, "doc_id", "vec")


def cell_vectors(spark, sf_dir):
    described = pl.extract(si.described_traffic(spark, sf_dir), S, S.text_period)
    words = staged(spark, si.word_vectors(spark, sf_dir), "words")
    poi = staged(spark, si.poi(spark, sf_dir), "poi")
    return pl.text_vectors(described, poi, words, S, lambda name, df: staged(spark, df, name))


@query
def cell_text_vector(spark, sf_dir):
    return long_form(cell_vectors(spark, sf_dir), "cell", "vec")


@query
def poi_minmax(spark, sf_dir):
    return long_form(ft.poi_vectors(si.poi(spark, sf_dir)), "cell", "poi")


@query
def cell_code(spark, sf_dir):
    return ft.cell_codes(ft.usable_poi(si.poi(spark, sf_dir)))


@query
def attach_poi(spark, sf_dir):
    located = ev.locate(extracted(spark, sf_dir)).select("event_id", "cell")
    joined = ft.attach_poi(located, ft.poi_vectors(si.poi(spark, sf_dir)))
    return joined.select("event_id", "cell", r6(checksum("poi")).alias("checksum"))


@query
def attach_text(spark, sf_dir):
    located = ev.locate(extracted(spark, sf_dir)).select("event_id", "cell")
    joined = ft.attach_text(located, cell_vectors(spark, sf_dir), si.DIMS)
    return joined.select("event_id", "cell", r6(checksum("text")).alias("checksum"))


# --- splits, sequences, sampling, model --------------------------------------

@query
def chrono_split(spark, sf_dir):
    clean = staged(spark, clean_grid(spark, sf_dir), "clean", "city")
    return ex.chrono_split(clean).select("city", "cell", "step", "split")


@query
def split_minmax(spark, sf_dir):
    clean = staged(spark, clean_grid(spark, sf_dir), "clean", "city")
    scaled = ex.scale_by_train(ex.chrono_split(clean))
    return scaled.select("city", "cell", "step", "split", *(r6(F.col(c)).alias(c) for c in SCALED_COLUMNS))


@query
def lookback_sequence(spark, sf_dir):
    clean = staged(spark, clean_grid(spark, sf_dir), "clean", "city")
    split = ex.chrono_split(clean)
    features = F.array(*(F.col(c).cast("double") for c in ("t_accident", "daylight", "w_rain")))
    rows = split.select("city", "cell", "split", "step", features.alias("features"))
    return ex.lookback(rows, S.lookback).select(
        "city", "cell", "split", "step", F.size("sequence").cast("long").alias("width"),
        checksum("sequence").alias("checksum"),
    )


@query
def negative_sample(spark, sf_dir):
    return ex.sample_negatives(clean_grid(spark, sf_dir), S.seed, S.keep_share).select(
        "city", "cell", "step", F.col("predicted_accident").cast("long").alias("label")
    )


@query
def assemble_example(spark, sf_dir):
    return examples(spark, sf_dir).select(
        "city", "split", "cell", "step", F.col("label").cast("long").alias("label"),
        F.size("feature").cast("long").alias("width"),
        F.round(checksum("feature"), 4).alias("checksum"),
    )


@query
def class_metrics(spark, sf_dir):
    predictions = si.table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )
    metrics = ml.class_metrics(predictions)
    return metrics.select(*(r6(F.col(c)).alias(c) for c in metrics.columns))


@query
def fit_logreg(spark, sf_dir):
    """What SQL can say of the models: which there are, on how many rows, and what holds of any."""
    rows = staged(spark, examples(spark, sf_dir), "examples", "city", "split")
    models = pl.city_models(rows, S.cities)
    measures = ("accuracy", "weighted_recall", "weighted_f1")
    within = reduce(and_, (F.col(m).between(0, 1) for m in measures))
    return models.select(
        "city", "width", "train_rows", "test_rows", "test_positives",
        (F.abs(F.col("accuracy") - F.col("weighted_recall")) < 1e-9).alias("accuracy_is_recall"),
        within.alias("within_0_1"))
