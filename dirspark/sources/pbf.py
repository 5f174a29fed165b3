"""Binary map extracts (PBF): a source that Spark splits by blobs, and the places and businesses in them.

A file is a row of blobs, each with its own strings and coordinates as differences, so any run of whole blobs can be read by itself. The driver
reads the blobs' sizes only; executors read, inflate and decode their ranges. Relations are skipped.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from dirspark.operators.geography import way_centroids
from dirspark.sources.readers import is_business, is_place

OBJECTS = "kind string, id long, lat double, lon double, tags map<string,string>, refs array<long>"
ARROW = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64()))])
#: Bytes of blobs that one task reads; the format's own bounds for a blob and its header.
TASK_BYTES, MOST_HEADER, MOST_BLOB = 16 << 20, 64 << 10, 32 << 20


class Broken(ValueError):
    """The file is not what it says, or ends too early."""


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a message: integers, or the bytes of strings and messages."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        if (wire := tag & 7) == 0:
            value, at = varint(data, at)
        elif wire == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
            if at > len(data):
                raise Broken("a field goes beyond its message")
        elif wire in (1, 5):
            size = 8 if wire == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise Broken(f"wire type {wire}")
        yield tag >> 3, value


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise Broken("a number has no end")
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def packed(data: bytes) -> np.ndarray:
    """All numbers of a packed field at once."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, dtype=np.uint64)
    ends = np.flatnonzero(raw < 128)
    if not len(ends) or ends[-1] != len(raw) - 1:
        raise Broken("a number has no end")
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = 7 * (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw & 127).astype(np.uint64) << shift.astype(np.uint64), starts)


def signed(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(1)).astype(np.int64) ^ -(values & np.uint64(1)).astype(np.int64)


def summed(data: bytes) -> np.ndarray:
    return np.cumsum(signed(packed(data)))


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path else pafs.FileSystem.from_uri(path.replace("file:/", "file:///", 1)) if path.startswith("file:/") else (pafs.LocalFileSystem(), path)


def blobs(path: str) -> Iterator[tuple[int, int]]:
    """Place and size of each blob of data; only the headers between them are read."""
    fs, inner = opened(path)
    with fs.open_input_file(inner) as f:
        total, at = f.size(), 0
        while at < total:
            head = f.read_at(4, at)
            size = struct.unpack(">I", head)[0] if len(head) == 4 else MOST_HEADER + 1
            if size > MOST_HEADER:
                raise Broken(f"{path}: no blob at byte {at}")
            told = dict(fields(f.read_at(size, at + 4)))
            at += 4 + size
            n = told.get(3, 0)
            if n > MOST_BLOB or at + n > total:
                raise Broken(f"{path}: the blob at byte {at} is cut off")
            if told.get(1) == b"OSMData":
                yield at, n
            at += n


def inflated(blob: bytes) -> bytes:
    told = dict(fields(blob))
    if 1 in told:
        return told[1]
    if 3 in told:
        return zlib.decompress(told[3])
    raise Broken("a blob is neither raw nor deflated")


def decoded(block: bytes) -> pa.RecordBatch:
    """The nodes and ways of a block."""
    strings: list[str] = []
    groups: list[bytes] = []
    grain, lat0, lon0 = 100, 0, 0
    for number, value in fields(block):
        if number == 1:
            strings = [x.decode(errors="replace") for n, x in fields(value) if n == 1]
        elif number == 2:
            groups.append(value)
        elif number == 17:
            grain = value
        elif number == 19:
            lat0 = plain(value)
        elif number == 20:
            lon0 = plain(value)
    degrees = lambda x, zero: 1e-9 * (zero + grain * x)
    kinds, ids, lats, lons, tags, refs = [], [], [], [], [], []

    def add(kind: str, some: list, lat: list, lon: list, told: list, members: list) -> None:
        for x, y in zip((kinds, ids, lats, lons, tags, refs), ([kind] * len(some), some, lat, lon, told, members), strict=True):
            x += y

    for group in groups:
        for number, value in fields(group):
            if number == 1:
                m = dict(fields(value))
                lat, lon = (float(degrees(int(signed(np.array([m.get(k, 0)], dtype=np.uint64))[0]), z)) for k, z in ((8, lat0), (9, lon0)))
                add("node", [int(signed(np.array([m.get(1, 0)], dtype=np.uint64))[0])], [lat], [lon], [pairs(strings, m)], [None])
            elif number == 2:
                m = dict(fields(value))
                some = summed(m.get(1, b""))
                if not len(some) == len(summed(m.get(8, b""))) == len(summed(m.get(9, b""))):
                    raise Broken("ids and coordinates differ in number")
                told: list[list[tuple[str, str]]] = [[] for _ in some]
                listed, at, k = packed(m.get(10, b"")).tolist(), 0, 0
                while k < len(listed):  # key, value, key, value, 0 for each node
                    if listed[k] == 0:
                        at, k = at + 1, k + 1
                    else:
                        told[at].append((strings[listed[k]], strings[listed[k + 1]]))
                        k += 2
                add("node", some.tolist(), degrees(summed(m.get(8, b"")), lat0).tolist(), degrees(summed(m.get(9, b"")), lon0).tolist(), told, [None] * len(some))
            elif number == 3:
                m = dict(fields(value))
                add("way", [plain(m.get(1, 0))], [None], [None], [pairs(strings, m)], [summed(m.get(8, b"")).tolist()])
    return pa.record_batch([pa.array(x, t.type) for x, t in zip((kinds, ids, lats, lons, tags, refs), ARROW, strict=True)], schema=ARROW)


def plain(value: int) -> int:
    """A 64-bit number that isn't zigzag: large ones are negative."""
    return value - (1 << 64) if value >> 63 else value


def pairs(strings: list[str], m: dict) -> list[tuple[str, str]]:
    return [(strings[k], strings[v]) for k, v in zip(packed(m.get(2, b"")).tolist(), packed(m.get(3, b"")).tolist(), strict=True)]


@dataclass
class Blobs(InputPartition):
    """Some whole blobs of a file, by place and size."""

    path: str
    some: list[tuple[int, int]]


class PbfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.most = [p for p in options["path"].split(",") if p], int(options.get("task_bytes", TASK_BYTES))

    def partitions(self) -> list[Blobs]:
        out: list[Blobs] = []
        for path in self.paths:
            size = self.most
            for at, n in blobs(path):
                if size + n > self.most:
                    out.append(Blobs(path, []))
                    size = 0
                out[-1].some.append((at, n))
                size += n
        return out or [Blobs("", [])]

    def read(self, partition: Blobs) -> Iterator[pa.RecordBatch]:
        if partition.some:
            fs, inner = opened(partition.path)
            with fs.open_input_file(inner) as f:
                for at, n in partition.some:
                    yield decoded(inflated(f.read_at(n, at)))


class PbfSource(DataSource):
    """spark.read.format("pbf").load(path), after spark.dataSource.register(PbfSource)."""

    @classmethod
    def name(cls) -> str:
        return "pbf"

    def schema(self) -> str:
        return OBJECTS

    def reader(self, schema) -> PbfReader:
        return PbfReader(dict(self.options))


def map_objects(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """kind, id, lat, lon, tags and refs of all nodes and ways of a file, or of several with commas between them."""
    spark.dataSource.register(PbfSource)
    return spark.read.format("pbf").option("task_bytes", task_bytes).load(path)


def tagged_objects(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """osm_type, osm_id, lat, lon and tags of nodes and ways that are places or businesses; a way lies at the mean of its nodes.

    Only nodes of such ways are joined. A way of which the file has no node is left out, as are nodes outside the globe; a node that a way names twice counts twice.
    """
    objects = map_objects(spark, path, task_bytes)
    wanted = is_place(F.col("tags")) | is_business(F.col("tags"))
    valid = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    nodes = objects.where((F.col("kind") == "node") & valid)
    ways = objects.where((F.col("kind") == "way") & wanted).select(F.col("id").alias("way"), F.col("refs").alias("node_ids"), "tags")
    centres = way_centroids(ways.select("way", "node_ids"), nodes.select(F.col("id").alias("node"), "lat", "lon"))
    at_ways = ways.join(centres, "way").select(F.lit("way").alias("osm_type"), F.col("way").alias("osm_id"), "lat", "lon", "tags")
    return nodes.where(wanted).select(F.lit("node").alias("osm_type"), F.col("id").alias("osm_id"), "lat", "lon", "tags").unionByName(at_ways)


def places(objects: DataFrame) -> DataFrame:
    return objects.where(is_place(F.col("tags")))


def businesses(objects: DataFrame) -> DataFrame:
    return objects.where(is_business(F.col("tags")))
