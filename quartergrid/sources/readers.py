"""Scans of the five raw inputs.

CSV is read as text by header name and converted with ``try_`` casts: dirty
values become null and reach the reject tables, they never abort a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.config import POI_FIELDS, TEXT_DIMS
from quartergrid.functions.clock import clock_minutes, observation_time
from quartergrid.functions.text import number_array

# Source header -> column.
TRAFFIC_FIELDS = {
    "StartTime(UTC)": "start_utc",
    "EndTime(UTC)": "end_utc",
    "LocationLat": "lat",
    "LocationLng": "lng",
    "AirportCode": "airport",
    "Type": "type",
    "Description": "description",
}
# Source header -> numeric column, all required to be numbers.
OBSERVATION_FIELDS = {
    "Temp": "temperature",
    "WindChill": "wind_chill",
    "Humd": "humidity",
    "Pressure": "pressure",
    "Visib": "visibility",
    "WindSpeed": "wind_speed",
    "Precipitation": "precipitation",
}


def read_traffic(spark: SparkSession, path: str) -> DataFrame:
    """Traffic events: UTC times, coordinates, airport, type, description."""
    raw = spark.read.option("header", True).csv(path)
    text = {new: F.col(f"`{old}`") for old, new in TRAFFIC_FIELDS.items()}
    return raw.select(
        F.try_to_timestamp(text["start_utc"]).alias("start_utc"),
        F.try_to_timestamp(text["end_utc"]).alias("end_utc"),
        text["lat"].try_cast("double").alias("lat"),
        text["lng"].try_cast("double").alias("lng"),
        text["airport"].alias("airport"),
        text["type"].alias("type"),
        text["description"].alias("description"),
    )


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, cells): the cells of the first line with text of each file below ``path``."""
    lines = spark.read.text(path).select(
        "value", F.monotonically_increasing_id().alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))
    at_start = lines.filter("block = 0 and trim(value) <> ''")
    first = at_start.groupBy("file").agg(F.min_by("value", "line").alias("value"))
    bare = F.regexp_replace("value", "[\uFEFF\"\\r]", "")
    return first.select("file", F.transform(F.split(bare, ","), F.trim).alias("cells"))


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """Weather text of a folder with one ``<airport>.csv`` per airport.

    A folder partitioned as ``airport=<code>/`` is read as well, and filters on
    the airport prune its files. Each file has its columns in the order of its own
    first line: those lines are read as data before, and say at which place of a
    row a column is found. However many orders there are, one scan reads all files.
    A column that a file lacks is null. ``obs_id`` numbers the lines as they are
    read, those of a file in order: it decides between observations of equal time.
    """
    columns = ("Date", "Hour", *OBSERVATION_FIELDS, "Events", "Conditions")
    # One row per file, as the driver lists the files anyway.
    headers = first_lines(spark, path).select(
        "file", F.size("cells").alias("width"), F.array(*(F.array_position("cells", c) for c in columns)).alias("places")).collect()
    width = max((r.width for r in headers), default=1)
    places = spark.createDataFrame([(r.file, r.places) for r in headers], "file string, places array<long>")
    cells = [f"_c{i}" for i in range(width)]
    raw = spark.read.schema(", ".join(f"{c} string" for c in cells)).option("header", True).csv(path)
    airport = (
        F.col("airport").cast("string")
        if "airport" in raw.columns
        else F.regexp_replace("_metadata.file_name", r"\.csv$", "")
    )
    lines = raw.select(
        airport.alias("airport"), F.monotonically_increasing_id().alias("obs_id"),
        F.col("_metadata.file_path").alias("file"), F.array(*cells).alias("cells"))
    found = {c: F.get("cells", (F.get("places", F.lit(i)) - 1).cast("int")) for i, c in enumerate(columns)}
    names = {"Events": "events", "Conditions": "conditions"}
    return lines.join(places, "file").select("airport", "obs_id", *(v.alias(names.get(c, c)) for c, v in found.items()))


def parse_observations(text: DataFrame) -> DataFrame:
    """Typed observations with ``reject``: null when good, else the reason.

    An unreadable time or any unreadable number rejects the whole row, also
    in a field that no feature uses. Null tags are fine. ``raw`` holds the text
    of a rejected row.
    """
    numbers = [F.col(old).try_cast("double").alias(new) for old, new in OBSERVATION_FIELDS.items()]
    other = [c for c in text.columns if c not in ("Date", "Hour", *OBSERVATION_FIELDS)]
    typed = text.select(
        *other, observation_time(F.col("Date"), F.col("Hour")).alias("ts_local"), *numbers,
        F.to_json(F.struct("Date", "Hour", *OBSERVATION_FIELDS)).alias("raw"),
    )
    missing = [F.col(c).isNull() for c in OBSERVATION_FIELDS.values()]
    bad_number = missing[0]
    for m in missing[1:]:
        bad_number = bad_number | m
    reject = F.when(F.col("ts_local").isNull(), "time").when(bad_number, "number")
    return typed.withColumn("reject", reject).withColumn(
        "raw", F.when(F.col("reject").isNotNull(), F.col("raw"))
    )


def read_daylight(spark: SparkSession, path: str) -> DataFrame:
    """Headerless daylight table: city-state, day, sunrise and sunset minutes."""
    raw = spark.read.schema("place string, day string, sunrise string, sunset string").csv(
        path, header=False
    )
    return raw.select(
        "place",
        F.to_date(F.try_to_timestamp("day", F.lit("yyyy-M-d"))).alias("day"),
        clock_minutes(F.col("sunrise")).alias("sunrise"),
        clock_minutes(F.col("sunset")).alias("sunset"),
    )


def read_poi(spark: SparkSession, path: str) -> DataFrame:
    """Points of interest: cell and 14 integer counts."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.col("Geohash").alias("cell"), *(F.col(c).try_cast("int").alias(c) for c in POI_FIELDS)
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``word f1 .. fN``; an unreadable number is null in the vector."""
    line = F.regexp_replace("value", "[\r\n]", "")
    word = F.substring_index(line, " ", 1)
    numbers = number_array(F.substr(line, F.length(word) + 2))
    return spark.read.text(path).select(word.alias("word"), numbers.alias("vec"))


def split_word_vectors(vectors: DataFrame, dims: int = TEXT_DIMS) -> tuple[DataFrame, DataFrame]:
    """(vectors of the given width, the others)."""
    good = (F.size("vec") == dims) & ~F.exists("vec", F.isnull)
    return vectors.filter(good), vectors.filter(~good)


def collapse_copies(df: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(one row per key, report of the keys that occur more than once).

    Identical rows are one row. Of rows that differ the greatest is kept, by the
    other columns in their order, nulls being least. The report has the number
    of rows of a key and whether they differ. One pre-aggregated shuffle: a key
    repeated a billion times travels as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("copies"), F.max(row).alias("row"), F.min(row).alias("least")
    )
    differ = ~F.col("row").eqNullSafe(F.col("least"))
    kept = grouped.select(*keys, "row.*").select(*df.columns)
    return kept, grouped.filter("copies > 1").select(*keys, "copies", differ.alias("differ"))
