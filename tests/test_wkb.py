"""Centroids against shapes worked out by hand."""

import struct

import pytest
from pyspark.sql import functions as F

from dirspark.functions.wkb import centroid, wkb_centroid
from dirspark.sources import readers


def head(kind, order="<"):
    return (b"\1" if order == "<" else b"\0") + struct.pack(order + "I", kind)


def seq(points, order="<"):
    return struct.pack(order + "I", len(points)) + b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def polygon(*rings, order="<", kind=3):
    return head(kind, order) + struct.pack(order + "I", len(rings)) + b"".join(seq(r, order) for r in rings)


def many(kind, *parts):
    return head(kind) + struct.pack("<I", len(parts)) + b"".join(parts)


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


POINT = head(1) + struct.pack("<2d", 78.5, 17.25)
LINE = head(2) + seq([(0, 0), (4, 0), (4, 2)])
CASES = [
    (POINT, (78.5, 17.25)), (head(1, ">") + struct.pack(">2d", 3, 4), (3, 4)), (LINE, (16 / 6, 2 / 6)), (polygon(box(0, 0, 4, 2)), (2, 1)), (polygon(box(0, 0, 4, 2)[::-1], order=">"), (2, 1)),
    (polygon([(0, 0), (3, 0), (0, 3), (0, 0)]), (1, 1)),
    (polygon(box(0, 0, 4, 4), box(2, 0, 2, 4)), (1, 2)),  # half of it is a hole
    (many(6, polygon(box(0, 0, 1, 1)), polygon(box(10, 0, 3, 1))), ((0.5 + 3 * 11.5) / 4, 0.5)),
    (many(7, POINT, LINE, polygon(box(0, 0, 2, 2))), (1, 1)),  # points and lines don't count beside an area
    (many(4, POINT, head(1) + struct.pack("<2d", 79.5, 18.25)), (79, 17.75)), (many(5, LINE, head(2) + seq([(0, 0), (0, 6)])), (16 / 12, 20 / 12)),
    (polygon([(x, y, 9.0) for x, y in box(0, 0, 4, 2)], kind=1003), (2, 1)), (polygon([(x, y, 9.0) for x, y in box(0, 0, 4, 2)], kind=0x80000003), (2, 1)),
    (polygon([(1, 1), (3, 1), (1, 1)]), (2, 1)), (polygon([(5, 5), (5, 5), (5, 5)]), (5, 5)),
    (None, (None, None)), (b"", (None, None)), (POINT[:-3], (None, None)), (head(99), (None, None)), (many(7), (None, None)), (head(1) + struct.pack("<2d", float("nan"), float("nan")), (None, None)),
]


@pytest.mark.parametrize("data,want", CASES)
def test_centroids(data, want):
    assert centroid(data) == pytest.approx(want)


def test_small_rings_far_out_keep_their_digits():
    x, y = centroid(polygon(box(78.123456, 17.654321, 1e-6, 1e-6)))
    assert abs(x - 78.1234565) < 1e-12 and abs(y - 17.6543215) < 1e-12


def test_as_columns(spark):
    rows = spark.createDataFrame([(i, bytearray(d) if d is not None else None) for i, (d, _) in enumerate(CASES)], "i int, geometry binary")
    got = {r.i: (r.c.lon, r.c.lat) for r in rows.select("i", wkb_centroid("geometry").alias("c")).collect()}
    assert all(got[i] == pytest.approx(want) for i, (_, want) in enumerate(CASES))


def test_places_lie_at_their_shape_s_centre(spark, tmp_path):
    shape = polygon([(70.0, 20.0), (70.3, 20.0), (70.0, 20.3), (70.0, 20.0)])
    columns = [
        "'a' AS id", "struct('N' AS primary) AS names", "struct('c' AS primary, array('d') AS alternate) AS categories", "array('1') AS phones", "array('w') AS websites", "0.9D AS confidence",
        "array(struct('IN' AS country, 'f' AS freeform, 'l' AS locality, '1' AS postcode)) AS addresses", "struct(70.0D AS xmin, 70.3D AS xmax, 20.0D AS ymin, 20.3D AS ymax) AS bbox",
    ]
    base = spark.range(1).selectExpr(*columns)
    base.withColumn("geometry", F.lit(bytearray(shape))).write.parquet(str(tmp_path / "with"))
    base.write.parquet(str(tmp_path / "without"))
    got = readers.places_parquet(spark, str(tmp_path / "with")).first()
    assert (got.lon, got.lat) == pytest.approx((70.1, 20.1))
    got = readers.places_parquet(spark, str(tmp_path / "without")).first()
    assert (got.lon, got.lat) == pytest.approx((70.15, 20.15))
