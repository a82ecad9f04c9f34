"""Geographic column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the spherical law of cosines; null if any coordinate is null.

    Rounding can push the cosine beyond 1, which would make the distance of identical points NaN, so it
    is clamped. The null guard comes first, because least() and greatest() skip nulls.
    """
    a, b = F.radians(lat1), F.radians(lat2)
    turn = F.radians(lon1) - F.radians(lon2)
    cosine = F.cos(a) * F.cos(b) * F.cos(turn) + F.sin(a) * F.sin(b)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, F.lit(EARTH_KM) * F.acos(clamped))


def _cell(value: Column, low: float, span: float, bits: int) -> Column:
    """Number of the cell that holds value; a value on a border belongs to the lower cell."""
    top = (1 << bits) - 1
    at = F.ceil((value - F.lit(low)) / F.lit(span) * F.lit(float(1 << bits))) - 1
    return F.least(F.lit(top), F.greatest(F.lit(0), at)).cast("long")


def geohash(lat: Column, lon: Column, precision: int = 5) -> Column:
    """Geohash of a point: longitude and latitude bits interleaved, five to a letter."""
    n = 5 * precision
    lon_bits, lat_bits = (n + 1) // 2, n // 2
    x, y = _cell(lon, -180.0, 360.0, lon_bits), _cell(lat, -90.0, 180.0, lat_bits)
    letters = []
    for c in range(precision):
        bits = []
        for i in range(5 * c, 5 * c + 5):
            source, at = (x, lon_bits - 1 - i // 2) if i % 2 == 0 else (y, lat_bits - 1 - i // 2)
            bit = F.shiftright(source, at).bitwiseAND(F.lit(1))
            bits.append(F.shiftleft(bit, 4 - i % 5))
        letters.append(F.substring(F.lit(BASE32), reduce(Column.__add__, bits).cast("int") + 1, F.lit(1)))
    return F.concat(*letters)


def closed_ring(points: Column) -> Column:
    """The ring with its first point repeated at the end, unless it ends there already."""
    return F.when(F.element_at(points, 1) != F.element_at(points, -1), F.concat(points, F.slice(points, 1, 1))).otherwise(points)


def bounding_box(points: Column) -> dict[str, Column]:
    """Least and largest longitude and latitude of [lon, lat] points."""
    lons, lats = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return {"min_lat": F.array_min(lats), "max_lat": F.array_max(lats), "min_lon": F.array_min(lons), "max_lon": F.array_max(lons)}
