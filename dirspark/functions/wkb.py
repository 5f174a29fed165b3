"""Centroids of geometries in well-known binary, by area, length or number as their dimension has it."""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

CENTRE = T.StructType([T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(1, 8)


def pieces(data: bytes, at: int = 0) -> tuple[list[tuple[int, list]], int]:
    """The simple parts of a geometry, each with its dimension (0 point, 1 line, 2 polygon) and its rings of (x, y), and where it ends. Z and M are skipped."""
    order = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    at += 4 * bool(kind & 0x20000000)  # an SRID
    width = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
    kind &= 0xFFFFFFF
    width += (0, 1, 1, 2)[kind // 1000]
    kind %= 1000

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def points(n: int) -> list[tuple[float, float]]:
        nonlocal at
        flat = struct.unpack_from(f"{order}{n * width}d", data, at)
        at += 8 * n * width
        return list(zip(flat[::width], flat[1::width], strict=True))

    if kind == POINT:
        return [(0, [p]) for p in [points(1)] if not math.isnan(p[0][0])], at
    if kind == LINE:
        return [(1, [p]) for p in [points(count())] if p], at
    if kind == POLYGON:
        rings = [points(count()) for _ in range(count())]
        return [(2, rings)] if rings and rings[0] else [], at
    if MULTIPOINT <= kind <= COLLECTION:
        out = []
        for _ in range(count()):
            some, at = pieces(data, at)
            out += some
        return out, at
    raise ValueError(f"geometry type {kind}")


def line_sums(line: list) -> tuple[float, float, float]:
    """Length, and length times the middle, of a line."""
    w = x = y = 0.0
    for (a, b), (c, d) in zip(line, line[1:], strict=False):
        n = math.hypot(c - a, d - b)
        w, x, y = w + n, x + n * (a + c) / 2, y + n * (b + d) / 2
    return w, x, y


def ring_sums(ring: list) -> tuple[float, float, float]:
    """Area, and area times the centre, of a ring, whichever way it runs; measured from its first point, so that small rings far out keep their digits."""
    x0, y0 = ring[0]
    w = x = y = 0.0
    for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
        a, b, c, d = a - x0, b - y0, c - x0, d - y0
        n = a * d - c * b
        w, x, y = w + n / 2, x + n * (a + c) / 6, y + n * (b + d) / 6
    w, x, y = (-w, -x, -y) if w < 0 else (w, x, y)
    return w, x + w * x0, y + w * y0


def centroid(data: bytes | None) -> tuple[float | None, float | None]:
    """Longitude and latitude (x and y) of the centre of the parts of the highest dimension that has any extent; holes count against their polygon.

    Null for null, empty and broken geometries. Polygons without area count by their lines, and lines without length by their points.
    """
    try:
        parts = pieces(bytes(data))[0] if data is not None else []
    except (struct.error, IndexError, ValueError):
        return None, None
    for dimension in (2, 1, 0):
        sums = [0.0, 0.0, 0.0]
        for kind, rings in parts:
            if kind < dimension:
                continue
            for k, ring in enumerate(rings):
                if dimension == 2:
                    got = [(-1 if k else 1) * v for v in ring_sums(ring)]
                elif dimension == 1:
                    got = line_sums(ring)
                else:
                    got = (len(ring), sum(p[0] for p in ring), sum(p[1] for p in ring))
                sums = [a + b for a, b in zip(sums, got, strict=True)]
        if sums[0] > 0:
            return sums[1] / sums[0], sums[2] / sums[0]
    return None, None


@pandas_udf(CENTRE)
def wkb_centroid(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Struct of lon and lat. Spark has no such function for its geometries, and rings nest to any depth."""
    for part in parts:
        yield pd.DataFrame([centroid(g) for g in part], columns=["lon", "lat"], dtype="float64")
