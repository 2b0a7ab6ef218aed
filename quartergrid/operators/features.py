"""Per-cell features: scaled points of interest, codes, text vectors."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import POI_FIELDS, PRECISION

# Letters after the prefix that cells are numbered in: at most 32**3 cells each.
CODE_LETTERS = 3


def usable_poi(poi: DataFrame) -> DataFrame:
    """Rows whose counts are all present."""
    return poi.dropna(subset=["cell", *POI_FIELDS])


def unusable_poi(poi: DataFrame) -> DataFrame:
    """Rows that :func:`usable_poi` leaves out."""
    present = [F.col(c).isNotNull() for c in ("cell", *POI_FIELDS)]
    return poi.filter(~reduce(and_, present))


def poi_vectors(poi: DataFrame) -> DataFrame:
    """(cell, poi): the 14 counts scaled to 0..1 over the whole table.

    A constant column becomes 0.5. The ranges are a one-row subquery of the plan:
    nothing runs before the result is asked for.
    """
    usable = usable_poi(poi)
    bounds = [end(c).cast("double").alias(f"{c}_{name}") for c in POI_FIELDS for name, end in (("low", F.min), ("high", F.max))]
    ranges = usable.agg(*bounds).select(F.struct("*").alias("ranges")).scalar()

    def scaled(name: str) -> Column:
        low, high = F.col("ranges")[f"{name}_low"], F.col("ranges")[f"{name}_high"]
        return F.when(high > low, (F.col(name) - low) / (high - low)).otherwise(0.5)

    return usable.withColumn("ranges", ranges).select("cell", F.array(*(scaled(c) for c in POI_FIELDS)).alias("poi"))


def cell_codes(cells: DataFrame, precision: int = PRECISION) -> DataFrame:
    """(cell, cell_code): position in alphabetical order, from 0.

    Cells are numbered within their prefix and shifted by the number of cells
    in earlier prefixes, so no task sorts all cells. Only the prefix counts
    meet in one task.
    """
    keyed = cells.select("cell").distinct().withColumn(
        "prefix", F.substring("cell", 1, max(0, precision - CODE_LETTERS))
    )
    earlier = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))
        .select("prefix", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    )
    inside = Window.partitionBy("prefix").orderBy("cell")
    return (
        keyed.withColumn("rank", F.row_number().over(inside) - 1)
        .join(shifts, "prefix")
        .select("cell", (F.col("shift") + F.col("rank")).alias("cell_code"))
    )


def cells_without_poi(cells: DataFrame, poi: DataFrame) -> DataFrame:
    """Cells that :func:`attach_poi` drops."""
    return cells.select("cell").distinct().join(usable_poi(poi), "cell", "left_anti")


def attach_poi(rows: DataFrame, poi: DataFrame) -> DataFrame:
    """Add the scaled counts of the cell; cells without any drop out."""
    return rows.join(poi.select("cell", "poi"), "cell")


def attach_text(rows: DataFrame, vectors: DataFrame, dims: int) -> DataFrame:
    """Add the text vector of the cell, zeros where there is none."""
    text = vectors.select("cell", F.col("vec").alias("text"))
    zeros = F.array_repeat(F.lit(0.0), dims)
    return rows.join(text, "cell", "left").withColumn("text", F.coalesce("text", zeros))


def cell_features(
    cells: DataFrame, poi: DataFrame, vectors: DataFrame, dims: int, precision: int = PRECISION
) -> DataFrame:
    """(cell, cell_code, poi, text) of the cells that have all they need."""
    known = attach_poi(cells.select("cell").distinct(), poi_vectors(poi))
    return attach_text(known.join(cell_codes(usable_poi(poi), precision), "cell"), vectors, dims)
