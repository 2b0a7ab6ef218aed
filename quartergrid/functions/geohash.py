"""Geohash cells as native column expressions.

A cell of precision ``p`` is one square of a regular lattice: ``5p`` bits are
dealt alternately to longitude (first) and latitude. A point on a boundary
belongs to the lower square, as with repeated halving by a strict ``>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash alphabet.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"

# The digits of ``conv`` in base 32.
CONV32 = "0123456789abcdefghijklmnopqrstuv"

# Fixed value: mean earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0088


def lattice_bits(precision: int) -> tuple[int, int]:
    """(longitude bits, latitude bits) of a cell."""
    bits = 5 * precision
    return (bits + 1) // 2, bits // 2


def lattice_index(value: Column, span: float, bits: int) -> Column:
    """Index of ``value`` in ``[-span/2, span/2]`` cut into ``2**bits`` parts."""
    size = 1 << bits
    index = F.ceil(value / F.lit(span / size)) + F.lit(size // 2 - 1)
    # A null coordinate has no index; least and greatest alone would skip it.
    inside = F.least(F.greatest(index, F.lit(0)), F.lit(size - 1))
    return F.when(value.isNotNull(), inside)


def _spread(index: Column) -> Column:
    """Move bit ``i`` of an index to bit ``2i``: its binary digits in base 4."""
    return F.conv(F.bin(index), 4, 10).cast("long")


def cell_of(lat: Column, lng: Column, precision: int = 5) -> Column:
    """Geohash of a point. Coordinates pass through 32-bit floats."""
    lng_bits, lat_bits = lattice_bits(precision)
    col = _spread(lattice_index(lng.cast("float").cast("double"), 360.0, lng_bits))
    row = _spread(lattice_index(lat.cast("float").cast("double"), 180.0, lat_bits))
    # The last bit of a code is a longitude bit when their number is odd.
    code = col + row * 2 if lng_bits > lat_bits else row + col * 2
    digits = F.lower(F.conv(code.cast("string"), 10, 32))
    return F.lpad(F.translate(digits, CONV32, BASE32), precision, BASE32[0])


def lattice_of(cell: Column, precision: int = 5) -> tuple[Column, Column]:
    """(row, column) of a cell on the lattice: the inverse of :func:`cell_of`."""
    pairs = F.conv(F.translate(cell, BASE32, CONV32), 32, 4)
    low = F.conv(F.translate(pairs, "0123", "0101"), 2, 10).cast("int")
    high = F.conv(F.translate(pairs, "0123", "0011"), 2, 10).cast("int")
    lng_bits, lat_bits = lattice_bits(precision)
    return (high, low) if lng_bits > lat_bits else (low, high)


def row_latitude(row: Column, precision: int = 5) -> Column:
    """Latitude of the middle of a lattice row."""
    step = 180.0 / (1 << lattice_bits(precision)[1])
    return F.lit(-90.0) + (row + F.lit(0.5)) * F.lit(step)


def column_longitude(col: Column, precision: int = 5) -> Column:
    """Longitude of the middle of a lattice column."""
    step = 360.0 / (1 << lattice_bits(precision)[0])
    return F.lit(-180.0) + (col + F.lit(0.5)) * F.lit(step)


def great_circle_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Haversine distance in kilometres, to the millimetre.

    The rounding makes distances that are equal by symmetry compare equal.
    """
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(
        F.sin((F.radians(lng2) - F.radians(lng1)) / 2), F.lit(2.0)
    )
    return F.round(F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0)))), 6)
