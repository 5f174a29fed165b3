"""Distances and grid cells on latitude and longitude, as plain columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.19
#: South, north, west, east of the country.
BOX = (6.0, 37.6, 68.0, 97.5)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres on a sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def cell(lat: Column, lon: Column, width: float) -> Column:
    """The grid cell of a point as one number."""
    return F.floor(lat / width).cast("long") * 1_000_000 + F.floor(lon / width).cast("long")


def neighbours(lat: Column, lon: Column, width: float, reach: int = 1) -> Column:
    """The cells within reach of a point's own, itself included."""
    steps = [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]
    return F.array(*[cell(lat, lon, width) + (i * 1_000_000 + j) for i, j in steps])


#: The edge in km of a cube that holds the globe, and how often it is halved at most (to 0.25 km).
WIDEST, FINEST = 16384.0, 16


def on_sphere(lat: Column, lon: Column) -> list[Column]:
    """The point in km from a corner of the widest cube: no seam at 180 degrees, and poles are points like others."""
    lat, lon, half = F.radians(lat), F.radians(lon), F.lit(WIDEST / 2)
    return [half + EARTH_KM * x for x in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]


def cube_key(level: Column, indexes: list[Column]) -> Column:
    """One number for a cube, from its level and its place along each axis (-1 to 2 ** FINEST)."""
    out = level.cast("long")
    for i in indexes:
        out = out * 131_072 + (i + 1)
    return out


def cubes(xyz: list[Column]) -> Column:
    """The level and key of the cube of each level that holds a point."""
    return F.array(*[F.struct(F.lit(n).alias("level"), cube_key(F.lit(n), [F.floor(x * (2.0**n / WIDEST)).cast("long") for x in xyz]).alias("cube")) for n in range(FINEST + 1)])


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float] = BOX) -> Column:
    return lat.between(box[0], box[1]) & lon.between(box[2], box[3])
