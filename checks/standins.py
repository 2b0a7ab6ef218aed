"""Stand-in inputs derived from the given tables (see FIXTURES.md).

Each function reads whole tables and returns a lazy DataFrame shaped like one
of the raw inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.config import CITIES as ALL_CITIES
from quartergrid.config import POI_FIELDS, GridWindow
from quartergrid.functions.text import arrow_tokens, lowered
from quartergrid.operators.events import locate
from quartergrid.plans.pipeline import Settings
from quartergrid.session import use_utc

CITIES = tuple(c for name in ("Austin", "Atlanta", "LosAngeles") for c in ALL_CITIES if c.name == name)
WINDOW = GridWindow(datetime(2024, 1, 5), datetime(2024, 1, 25, 23, 59, 59))
PERIOD = (datetime(2024, 1, 3), datetime(2024, 1, 28))
DIMS = 64
SETTINGS = Settings(
    cities=CITIES, window=WINDOW, grid_period=PERIOD, text_period=PERIOD, text_dims=DIMS
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def token_hash(text: Column) -> Column:
    """First 8 hex digits of md5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic events; ``props`` stands for a short description."""
    by_three = F.col("user_id") % 3
    kind = (
        F.when(F.col("event_id") % 17 == 0, "Other")
        .when(F.col("event_id") % 13 == 0, "Debris-Road")
        .when(F.col("event_id") % 11 == 0, "Event")
        .when(F.col("event_id") % 7 == 0, "Flow-Incident")
        .when(F.col("event_type") == "error", "Accident")
        .when(F.col("event_type") == "click", "Congestion")
        .when(F.col("event_type") == "purchase", "Construction")
        .when(F.col("event_type") == "signup", "Lane-Blocked")
        .otherwise("Broken-Vehicle")
    )

    def base(a: float, b: float, c: float) -> Column:
        return (
            F.when(F.col("user_id") % 10 == 9, 0.0)
            .when(by_three == 0, a).when(by_three == 1, b).otherwise(c)
        )

    even = F.col("user_id") % 2 == 0
    airport = (
        F.when(F.col("user_id") % 5 == 0, "X1")
        .when(by_three == 0, F.when(even, "KAUS").otherwise("KEDC"))
        .when(by_three == 1, F.when(even, "KATL").otherwise("KFTY"))
        .otherwise(F.when(even, "KLAX").otherwise("KBUR"))
    )
    minutes = ((F.col("event_id") % 5) * 20).cast("int")
    return events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("start_utc"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))).alias("end_utc"),
        (base(30.10, 33.63, 33.72) + F.lit(0.04) * (F.col("user_id") % 7)).alias("lat"),
        (base(-97.95, -84.56, -118.67) + F.lit(0.04) * (F.col("user_id") % 8)).alias("lng"),
        airport.alias("airport"),
        kind.alias("type"),
        F.col("props").alias("description"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in many tasks: the small file is one row group, which one task reads."""
    return table(spark, sf_dir, "documents").repartition("doc_id")


def described_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traffic with whole documents as descriptions, every document in use."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    count = documents.count()
    return (
        traffic(spark, sf_dir)
        .withColumn("doc_id", F.col("event_id") % count)
        .join(documents, "doc_id")
        .withColumn("description", F.col("text"))
        .drop("text")
    )


def observations_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather observations with UTC times: one per event."""
    def measure(every: int, value: Column) -> Column:
        return F.when(F.col("event_id") % every == 0, -9999.0).otherwise(value)

    airports = F.array(*(F.lit(a) for a in ("KAUS", "KEDC", "KATL", "KFTY", "KLAX", "KBUR")))
    skies = F.array(*(F.lit(a) for a in (
        "Light Rain , Snow", "Haze", "Snow", "Ice Pellets", "", "Clear")))
    tags = F.array(F.lit("Fog"), F.lit(""), F.lit("Hail"), F.lit(None).cast("string"))
    value = F.col("value")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("obs_id"),
        F.col("ts").alias("ts_utc"),
        F.get(airports, (F.col("user_id") % 6).cast("int")).alias("airport"),
        measure(9, value).alias("temperature"),
        measure(8, value / 2).alias("humidity"),
        measure(10, value + 900).alias("pressure"),
        measure(11, value / 5).alias("visibility"),
        measure(12, value * 2).alias("wind_speed"),
        measure(7, value / 10).alias("precipitation"),
        F.get(skies, (F.col("event_id") % 6).cast("int")).alias("conditions"),
        F.get(tags, (F.col("event_id") % 4).cast("int")).alias("events"),
    )


def observation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as text rows, some with unreadable times or numbers."""
    obs = observations_utc(spark, sf_dir)
    hour = F.date_format("ts_utc", "h:mm a")

    def text(name: str) -> Column:
        return F.col(name).cast("decimal(18,3)").cast("string")

    return obs.select(
        "airport", "obs_id",
        F.date_format("ts_utc", "yyyy-MM-dd").alias("Date"),
        F.when(F.col("obs_id") % 19 == 0, "25:61 xx").otherwise(hour).alias("Hour"),
        F.when(F.col("obs_id") % 23 == 0, "n/a").otherwise(text("temperature")).alias("Temp"),
        F.when(F.col("obs_id") % 29 == 0, "-").otherwise(text("temperature")).alias("WindChill"),
        text("humidity").alias("Humd"),
        text("pressure").alias("Pressure"),
        text("visibility").alias("Visib"),
        text("wind_speed").alias("WindSpeed"),
        text("precipitation").alias("Precipitation"),
        F.col("events").alias("Events"),
        F.col("conditions").alias("Conditions"),
    )


def daylight_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City-state, unpadded day, sunrise and sunset text of the event days."""
    days = events(spark, sf_dir).select(F.to_date("ts").alias("d")).distinct()
    place = F.explode(F.array(*(F.lit(f"{c.name}-{c.state}") for c in CITIES)))
    two = F.lpad(F.day("d").cast("string"), 2, "0")
    return days.filter(F.day("d") % 10 != 0).select(
        place.alias("place"),
        F.date_format("d", "yyyy-M-d").alias("day"),
        F.concat(F.lit("7:"), two, F.lit(" am")).alias("sunrise"),
        F.concat(F.lit("5:"), two, F.lit(" pm")).alias("sunset"),
    )


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cell with traffic, some cells left out."""
    cells = locate(traffic(spark, sf_dir))
    counts = [
        F.sum(F.when(F.col("event_id") % 14 == j, 1).otherwise(0)).cast("int").alias(name)
        for j, name in enumerate(POI_FIELDS[:13])
    ]
    return (
        cells.groupBy("cell")
        .agg(*counts, F.lit(1).alias(POI_FIELDS[13]), F.min("event_id").alias("first_id"))
        .filter("first_id % 8 != 0")
        .drop("first_id")
    )


def word_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token without white space, with a vector from ``embeddings``."""
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("vec")
    )
    count = vectors.count()
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each batch, once: many fewer rows than tokens."""
        for batch in batches:
            yield pa.RecordBatch.from_arrays([arrow_tokens(batch.column(0))[0].unique()], names=["word"])

    words = documents(spark, sf_dir).select(lowered(F.col("text")).alias("text")).mapInArrow(distinct, "word string")
    return (
        words.distinct().filter(~F.col("word").rlike(r"\s")).withColumn("vec_id", token_hash(F.col("word")) % count)
        .join(vectors, "vec_id")
        .select("word", "vec")
    )
