"""Nearest cell by great-circle distance, without pairing cells.

Cells lie on a lattice, whose squares are the boxes of coarser lattices up to one
of a few hundred boxes. Pairs of boxes, one with cells that look for a donor and one
with donors, are followed from coarse to fine. The middles of two boxes and their radii
bound the distance of all that is in them from below and above; a pair goes when
another donor box is sure to be nearer. Each round splits the boxes that are left, so a
cell looks at few of them however far its donor is. The result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import asin, cos, radians, sin, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartergrid.config import PRECISION
from quartergrid.functions.geohash import (
    EARTH_RADIUS_KM, column_longitude, great_circle_km, lattice_bits, lattice_of, row_latitude,
)

#: Bits of the rows and columns of the coarsest lattice: at most 16 x 32 boxes.
TOP_BITS = (4, 5)
#: Bits that a round adds to rows and columns: a box splits into 16 at most.
ROUND_BITS = 2
#: Kilometres that rounding may add to or take from a bound.
SLACK_KM = 1e-3


def _levels(precision: int) -> list[int]:
    """Bits by which the lattice of each round is coarser, down to 0."""
    lng_bits, lat_bits = lattice_bits(precision)
    top = max(0, lat_bits - TOP_BITS[0], lng_bits - TOP_BITS[1])
    return [*range(top, 0, -ROUND_BITS), 0]


def _with_lattice(cells: DataFrame, precision: int) -> DataFrame:
    row, col = lattice_of(F.col("cell"), precision)
    return cells.select("cell", row.alias("row"), col.alias("col"))


def _box(level: int, row: str = "row", col: str = "col") -> Column:
    """The box of a cell on the lattice that is ``level`` bits coarser."""
    return F.struct(F.shiftright(row, level).alias("row"), F.shiftright(col, level).alias("col"))


def _middle(index: Column, level: int) -> Column:
    """Place of the middle of a box among the middles of its cells."""
    return index * (1 << level) + F.lit(((1 << level) - 1) / 2)


def _point(box: str, level: int, precision: int) -> tuple[Column, Column]:
    return (row_latitude(_middle(F.col(f"{box}.row"), level), precision),
            column_longitude(_middle(F.col(f"{box}.col"), level), precision))


def _radius_km(level: int, precision: int) -> float:
    """No middle of a cell is farther from the middle of its box: half a diagonal at the equator."""
    reach = ((1 << level) - 1) / 2
    lng_bits, lat_bits = lattice_bits(precision)
    high, wide = radians(reach * 180.0 / (1 << lat_bits)), radians(reach * 360.0 / (1 << lng_bits))
    return 2 * EARTH_RADIUS_KM * asin(sqrt(sin(high / 2) ** 2 + (cos(high / 2) * sin(wide / 2)) ** 2))


def _pruned(pairs: DataFrame, level: int, precision: int) -> DataFrame:
    """Pairs (box, near) but those with a farther ``near`` than some other of the box.

    Cells of two boxes are as far apart as their middles, give or take both radii.
    """
    km = great_circle_km(*_point("box", level, precision), *_point("near", level, precision))
    room = 4 * _radius_km(level, precision) + SLACK_KM
    nearest = F.min("km").over(Window.partitionBy("box"))
    return pairs.withColumn("km", km).withColumn("nearest", nearest).filter(F.col("km") <= F.col("nearest") + room).select("box", "near")


def _rounds(targets: DataFrame, sources: DataFrame, precision: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(all pairs looked at, those that are left) of each round."""
    levels = _levels(precision)
    top = levels[0]
    # The coarsest lattice is small by its definition, and so is this one row.
    far = sources.agg(F.collect_set(_box(top)).alias("boxes")).scalar()
    pairs = targets.select(_box(top).alias("box")).distinct().select("box", F.explode(far).alias("near"))
    left = _pruned(pairs, top, precision)
    yield pairs, left
    for above, level in zip(levels, levels[1:]):
        splits = {}
        for name, cells in (("box", targets), ("near", sources)):
            splits[name] = cells.select(_box(above).alias(name), _box(level).alias(f"{name}_part")).distinct()
        pairs = left.join(splits["box"], "box").join(splits["near"], "near").select(
            F.col("box_part").alias("box"), F.col("near_part").alias("near"))
        left = _pruned(pairs, level, precision)
        yield pairs, left


def probe_counts(missing: DataFrame, donors: DataFrame, precision: int = PRECISION) -> list[int]:
    """How many pairs of boxes each round of :func:`nearest_cells` looks at."""
    sides = (_with_lattice(cells.select("cell").distinct(), precision) for cells in (missing, donors))
    return [pairs.count() for pairs, _ in _rounds(*sides, precision)]


def nearest_cells(missing: DataFrame, donors: DataFrame, precision: int = PRECISION) -> DataFrame:
    """(cell, donor, km): the nearest donor of each missing cell.

    Equal distances go to the alphabetically first donor. Without donors there
    is no row.
    """
    targets = _with_lattice(missing.select("cell").distinct(), precision)
    sources = _with_lattice(donors.select("cell").distinct(), precision)
    *_, (_, left) = _rounds(targets, sources, precision)
    names = targets.select(_box(0).alias("box"), "cell"), sources.select(_box(0).alias("near"), F.col("cell").alias("donor"))
    km = great_circle_km(*_point("box", 0, precision), *_point("near", 0, precision))
    best = left.join(names[0], "box").join(names[1], "near").groupBy("cell").agg(
        F.min(F.struct(km.alias("km"), F.col("donor"))).alias("best"))
    return best.select("cell", "best.donor", "best.km")


def complete_airports(cells: DataFrame, pairs: DataFrame, precision: int = PRECISION) -> DataFrame:
    """(cell, airport) for all cells: those without borrow from the nearest.

    Donors are cells with airports of their own, in any city.
    """
    owners = pairs.select("cell").distinct()
    missing = cells.select("cell").distinct().join(owners, "cell", "left_anti")
    borrowed = (
        nearest_cells(missing, owners, precision)
        .join(pairs.withColumnRenamed("cell", "donor"), "donor")
        .select("cell", "airport")
    )
    own = pairs.join(cells.select("cell").distinct(), "cell", "left_semi")
    return own.select("cell", "airport").unionByName(borrowed)
