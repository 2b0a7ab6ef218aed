"""Sinks and re-reads of the stage tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartergrid.config import CLEAN_GRID_COLUMNS, PUBLISHED_NAMES, RAW_GRID_COLUMNS
from quartergrid.functions.text import number_array


def save(df: DataFrame, path: str, *partition_by: str) -> str:
    """Write a stage table as parquet, replacing what is there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def load(spark: SparkSession, path: str) -> DataFrame:
    """Read a stage table. Filters on its partition columns prune folders."""
    return spark.read.parquet(path)


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int, sort: tuple[str, ...], *partition_by: str) -> str:
    """Write a stage table in buckets of ``key``, sorted, and return its table name.

    The files below ``path`` are parquet like those of :func:`save`. Read by the name,
    Spark knows how they are dealt out: windows and joins by ``key`` move nothing.
    ``df`` should come dealt out by ``repartition(buckets, key)`` or from such a table;
    otherwise every task writes to every bucket.
    """
    name = f"stage_{uuid4().hex}"
    writer = df.write.bucketBy(buckets, key).sortBy(*sort).option("path", path).mode("overwrite").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
    return name


def published(name: str) -> str:
    return PUBLISHED_NAMES.get(name, name)


def save_grid_csv(grid: DataFrame, path: str, clean: bool = False) -> str:
    """Write a grid with the published headers, one folder per city."""
    columns = CLEAN_GRID_COLUMNS if clean else RAW_GRID_COLUMNS
    out = grid.select("city", *(F.col(c).alias(published(c)) for c in columns))
    out.write.mode("overwrite").partitionBy("city").option("header", True).csv(path)
    return path


# Columns of a grid that are not numbers with a fraction.
_WHOLE = {c for c in RAW_GRID_COLUMNS + CLEAN_GRID_COLUMNS if not c.startswith("w_")} | {
    "w_rain", "w_snow", "w_fog", "w_hail"
}


def load_grid_csv(spark: SparkSession, path: str, clean: bool = False) -> DataFrame:
    """Read a grid written by :func:`save_grid_csv`."""
    columns = CLEAN_GRID_COLUMNS if clean else RAW_GRID_COLUMNS
    raw = spark.read.option("header", True).csv(path)

    def typed(name: str) -> Column:
        kind = "string" if name == "cell" else "long" if name in _WHOLE else "double"
        return F.col(f"`{published(name)}`").try_cast(kind).alias(name)

    return raw.select("city", *(typed(c) for c in columns))


def save_vectors_csv(vectors: DataFrame, path: str) -> str:
    """Write (cell, vec) with the vector as space-separated text."""
    text = F.array_join(F.transform("vec", lambda v: v.cast("string")), " ")
    out = vectors.select(F.col("cell").alias("Geohash"), text.alias("vec"))
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def load_vectors_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read (cell, vec) written as space-separated text."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(F.col("Geohash").alias("cell"), number_array(F.col("vec")).alias("vec"))
