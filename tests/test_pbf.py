"""Map extracts written here by hand, read back by blobs."""

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from dirspark.sources import pbf


def number(n):
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def zig(n):
    return n << 1 ^ n >> 63


def field(k, value):
    return number(k << 3) + number(value) if isinstance(value, int) else number(k << 3 | 2) + number(len(value)) + value


def deltas(values):
    return b"".join(number(zig(b - a)) for a, b in zip([0, *values[:-1]], values))


def blob(kind, data, deflate=True):
    body = field(2, len(data)) + field(3, zlib.compress(data)) if deflate else field(1, data)
    head = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def block(dense=(), nodes=(), ways=(), relations=0, grain=100, lat0=0, lon0=0):
    strings = [b""]

    def at(s):
        s = s.encode()
        if s not in strings:
            strings.append(s)
        return strings.index(s)

    unit = lambda x, zero: round((x * 1e9 - zero) / grain)
    groups = []
    if dense:
        told = b"".join(b"".join(number(at(k)) + number(at(v)) for k, v in tags.items()) + number(0) for *_, tags in dense)
        groups.append(field(2, field(1, deltas([x[0] for x in dense])) + field(8, deltas([unit(x[1], lat0) for x in dense])) + field(9, deltas([unit(x[2], lon0) for x in dense])) + field(10, told)))
    for i, lat, lon, tags in nodes:
        groups.append(field(1, field(1, zig(i)) + field(2, b"".join(number(at(k)) for k in tags)) + field(3, b"".join(number(at(v)) for v in tags.values())) + field(8, zig(unit(lat, lat0))) + field(9, zig(unit(lon, lon0)))))
    for i, refs, tags in ways:
        groups.append(field(3, field(1, i) + field(2, b"".join(number(at(k)) for k in tags)) + field(3, b"".join(number(at(v)) for v in tags.values())) + field(8, deltas(refs))))
    groups += [field(4, field(1, 5)) for _ in range(relations)]
    table = field(1, b"".join(field(1, s) for s in strings))
    return table + b"".join(field(2, g) for g in groups) + field(17, grain) + field(19, lat0) + field(20, lon0)


def write(path, *blocks, deflate=True):
    path.write_bytes(blob(b"OSMHeader", field(4, b"OsmSchema-V0.6")) + b"".join(blob(b"OSMData", b, deflate) for b in blocks))
    return str(path)


@pytest.fixture
def extract(tmp_path):
    rng = random.Random(1)
    loose = [(1000 + i, rng.uniform(-80, 80), rng.uniform(-179, 179), {}) for i in range(500)]
    dense = [(1, 17.0, 78.0, {}), (2, 17.0, 78.2, {}), (3, 17.2, 78.1, {"highway": "crossing"}), (7, 18.5, 79.5, {"place": "borough", "name": "Álpha"}), (9, -33.25, -70.5, {"shop": "bakery", "name": "Sur"}), (11, 1.0, 1.0, {"shop": "x"})]
    first = block(dense=dense, relations=2)
    second = block(nodes=[(-5, 10.0, 20.0, {"amenity": "cafe", "name": "C"}), (12, 5.0, 5.0, {"place": "island", "name": "no"})], ways=[(50, [1, 2, 3, 1], {"building": "yes", "shop": "mall", "name": "Way"}), (51, [900001], {"shop": "y", "name": "lost"}), (52, [1, 900001], {"place": "village", "name": "half"}), (53, [1, 2], {"shop": "z"})], grain=1000, lat0=500_000_000, lon0=-1_000_000_000)
    third = block(dense=loose)
    return write(tmp_path / "a.pbf", first, second, third), loose


def test_places_and_businesses(spark, extract):
    path, _ = extract
    found = pbf.tagged_objects(spark, path, 1).cache()
    got = {(r.osm_type, r.osm_id): (round(r.lat, 6), round(r.lon, 6), r.tags["name"]) for r in found.collect()}
    mean = (round((17.0 + 17.0 + 17.2 + 17.0) / 4, 6), round((78.0 + 78.2 + 78.1 + 78.0) / 4, 6))
    assert got == {("node", 7): (18.5, 79.5, "Álpha"), ("node", 9): (-33.25, -70.5, "Sur"), ("node", -5): (10.0, 20.0, "C"), ("way", 50): (*mean, "Way"), ("way", 52): (17.0, 78.0, "half")}
    assert {r.osm_id for r in pbf.places(found).collect()} == {7, 52} and {r.osm_id for r in pbf.businesses(found).collect()} == {9, -5, 50}


def test_every_object_once_however_split(spark, extract):
    path, loose = extract
    for size, parts in ((1, 3), (1 << 24, 1)):
        rows = pbf.map_objects(spark, path, size)
        assert rows.rdd.getNumPartitions() == parts
        nodes = {r.id: (r.lat, r.lon) for r in rows.where("kind = 'node'").collect()}
        assert len(nodes) == rows.where("kind = 'node'").count() == 8 + len(loose)
        assert all(abs(nodes[i][0] - lat) < 1e-7 and abs(nodes[i][1] - lon) < 1e-7 for i, lat, lon, _ in loose)
        assert rows.where("kind = 'way'").agg(F.sum(F.size("refs"))).first()[0] == 9


def test_raw_blobs_several_files_and_none(spark, tmp_path):
    a = write(tmp_path / "a.pbf", block(dense=[(1, 1.0, 2.0, {"place": "town", "name": "A"})]), deflate=False)
    b = write(tmp_path / "b.pbf")
    assert [r.id for r in pbf.map_objects(spark, f"{a},{b}").collect()] == [1]
    assert pbf.tagged_objects(spark, b).count() == 0


def test_cut_off_and_foreign_files_are_refused(spark, tmp_path):
    whole = (tmp_path / "a.pbf")
    write(whole, block(dense=[(i, 1.0, 2.0, {}) for i in range(200)]))
    (tmp_path / "cut.pbf").write_bytes(whole.read_bytes()[:-7])
    (tmp_path / "text.pbf").write_bytes(b"hello, this is not a map at all")
    for name in ("cut.pbf", "text.pbf"):
        with pytest.raises(Exception, match="cut off|no blob"):
            pbf.map_objects(spark, str(tmp_path / name)).count()
