"""Chunks pushed into a platform's table: checked at both ends, protected rows kept, new addresses linked, all in one commit.

A table is a folder of versions. A version's files are written below a name of its own and count only once a log entry names them; an entry is created
under the next number only if no one else has created it, so of two writers on one version the second sees a Conflict and starts again from the new one.
What a crash leaves behind is in no entry and is never read. Creating without overwriting is atomic on HDFS; on object stores it needs their conditional writes.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.operators.directory import protected_upsert

#: Business types that the platform knows as they are; all others become OTHER.
KNOWN_TYPES = ("RETAIL_STORE", "HOME_BUSINESS", "SERVICE_PROVIDER", "WHOLESALER", "MANUFACTURER")
KEYS = ("source_name", "source_record_id")


class Conflict(RuntimeError):
    """Another writer has committed this version."""


class ChecksumMismatch(RuntimeError):
    """What arrived is not what was sent."""


def platform_type(business_type: Column) -> Column:
    return F.when(business_type.isin(*KNOWN_TYPES), business_type).otherwise("OTHER")


def checksum(rows: DataFrame) -> str:
    """Count and sum of hashes of all rows, whatever their order; repeated rows count as often as they occur. Nulls differ from empty strings."""
    digest = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(digest, 1 + 12 * i, 12), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(5)]
    told = rows.agg(F.count(F.lit(1)).alias("n"), *parts).first()
    return ":".join(str(x or 0) for x in told)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.Path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def entries(self) -> list[int]:
        log = self.Path(f"{self.path}/log")
        return sorted(int(f.getPath().getName()) for f in self.fs.listStatus(log)) if self.fs.exists(log) else []

    def version(self) -> int:
        """The last committed version, 0 before the first."""
        return (self.entries() or [0])[-1]

    def entry(self, version: int) -> dict:
        lines = self.spark.read.text(f"{self.path}/log/{version:012d}").collect()
        return json.loads(lines[0].value)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the last or another version."""
        return self.spark.read.parquet(self.entry(version or self.version())["tables"][name])

    def stage(self, tables: dict[str, DataFrame]) -> dict[str, str]:
        """Write tables where no entry looks yet; their places."""
        place = f"{self.path}/data/{uuid.uuid4().hex}"
        for name, rows in tables.items():
            rows.write.parquet(f"{place}/{name}")
        return {name: f"{place}/{name}" for name in tables}

    def commit(self, base: int, tables: dict[str, str], **told: object) -> int:
        """Make staged tables the version after base, or raise Conflict. Tables not named stay as they were."""
        whole = {**(self.entry(base)["tables"] if base else {}), **tables}
        text = json.dumps({"tables": whole, "base": base, **told}, sort_keys=True).encode()
        try:
            out = self.fs.create(self.Path(f"{self.path}/log/{base + 1:012d}"), False)
        except Exception as e:
            raise Conflict(f"version {base + 1} exists") from e
        out.write(text)
        out.close()
        return base + 1


def send(rows: DataFrame, path: str) -> tuple[str, str]:
    """A chunk as Parquet below path, with the type that the platform knows; its place and checksum."""
    chunk = rows.withColumn("business_type", platform_type(F.col("business_type")))
    place = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    chunk.write.parquet(place)
    return place, checksum(chunk)


def receive(table: VersionedTable, place: str, sent: str, attempts: int = 5) -> int:
    """Take a chunk into the platform's table and link addresses; the new version.

    The chunk is refused if its checksum differs from the one that was sent. Claimed and verified rows stay as they are; others are replaced by source and record, and keep a phone or site
    that the chunk lacks. Every row without an address gets one (its line, code and position) and points to it, in the same commit. On a conflict all is done again from the version that won.
    A chunk that was taken in before changes nothing.
    """
    chunk = table.spark.read.parquet(place)
    if (got := checksum(chunk)) != sent:
        raise ChecksumMismatch(f"sent {sent}, arrived {got}")
    for _ in range(attempts):
        base = table.version()
        if any(table.entry(v).get("chunk") == sent for v in table.entries()):
            return base
        old = table.read("businesses") if base else chunk.where("false").withColumn("address_id", F.lit(None).cast("string"))
        rows = protected_upsert(old, chunk.withColumn("address_id", F.lit(None).cast("string")))
        ident = F.concat(F.lit("addr:"), F.sha2(F.to_json(F.struct(*KEYS)), 256))
        rows = rows.join(old.select(*KEYS, F.col("address_id").alias("_had")), list(KEYS), "left")
        new = F.coalesce("address_id", "_had").isNull() & (F.coalesce("address", "locality").isNotNull())
        rows = rows.withColumns({"_new": new, "address_id": F.coalesce("address_id", "_had", F.when(new, ident))}).drop("_had")
        staged = table.stage({"_all": rows})
        rows = table.spark.read.parquet(staged["_all"])
        added = rows.where("_new").select("address_id", F.coalesce("address", "locality").alias("line"), "code", "lat", "lon")
        addresses = added if not base else table.read("addresses").unionByName(added)
        places = table.stage({"businesses": rows.drop("_new"), "addresses": addresses})
        try:
            return table.commit(base, places, chunk=sent)
        except Conflict:
            continue
    raise Conflict(f"{attempts} attempts lost to other writers")
