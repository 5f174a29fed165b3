"""A paged source as a stream with stored offsets: pages that were fetched into a folder, each with so many records.

A page lies in any file whose path has offset=<number of records before it>. Pages are read in order up to the first that is missing or empty, so a
fetcher that gave up or is still busy is waited for, never skipped. The checkpoint stores how far reading came: a run that was killed starts
again at its last batch, with the same pages. A task reads one page, so a batch of many pages is as many tasks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from dirspark.functions.contact import looks_residential, six_digit_code
from dirspark.functions.text import canon, clean
from dirspark.sources.pbf import opened
from dirspark.sources.readers import register_activities
from dirspark.streaming.incremental import run_new

RECORDS = "page_offset long, place int, record string"
ARROW = pa.schema([("page_offset", pa.int64()), ("place", pa.int32()), ("record", pa.string())])
FIELDS = T.StructType([T.StructField(n, T.StringType()) for n in ("EnterpriseName", "State", "District", "Pincode", "CommunicationAddress", "Activities", "RegistrationDate")])
AT = re.compile(r"(?:^|/)offset=(\d+)(?=[./]|$)")


def page_files(folder: str) -> dict[int, list[str]]:
    """The non-empty files of each page that is there, by its offset. Hidden files and those of markers (_SUCCESS) are none."""
    fs, inner = opened(folder)
    found: dict[int, list[str]] = {}
    for x in fs.get_file_info(pafs.FileSelector(inner, recursive=True, allow_not_found=True)):
        if x.type == pafs.FileType.File and x.size and not x.base_name.startswith((".", "_")) and (at := AT.search(x.path[len(inner) :])):
            found.setdefault(int(at[1]), []).append(x.path)
    return {k: sorted(v) for k, v in found.items()}


def page_records(data: bytes) -> list[str]:
    """Records of a page as JSON: of a list, of an object's list 'records', or one in each line."""
    text = data.decode("utf-8", "replace").strip()
    try:
        tree = json.loads(text)
    except ValueError:
        return [x for x in text.split("\n") if x.strip()]
    if isinstance(tree, dict):
        tree = tree["records"] if isinstance(tree.get("records"), list) else [tree]
    return [json.dumps(x, ensure_ascii=False) for x in tree] if isinstance(tree, list) else []


@dataclass
class Page(InputPartition):
    offset: int
    files: list[str]


class PagedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.folder, self.each = options["path"], int(options["records_per_page"])
        if self.each < 1:
            raise ValueError("records_per_page must be 1 or more")

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        """The offset behind the last page of the unbroken run from 0."""
        there, at = page_files(self.folder), 0
        while at in there:
            at += self.each
        return {"next": at}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        """Pages from one offset to another. Those of a batch that is repeated must still be there."""
        there = page_files(self.folder)
        return [Page(at, there[at]) for at in range(start["next"], end["next"], self.each)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.folder)
        place = 0
        for path in partition.files:
            with fs.open_input_stream(path) as f:
                rows = page_records(f.read())
            yield pa.record_batch([pa.array([partition.offset] * len(rows), pa.int64()), pa.array(range(place, place + len(rows)), pa.int32()), pa.array(rows, pa.string())], schema=ARROW)
            place += len(rows)


class PagedSource(DataSource):
    """spark.readStream.format("paged").option("records_per_page", n).load(folder), after spark.dataSource.register(PagedSource)."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return RECORDS

    def streamReader(self, schema) -> PagedReader:
        return PagedReader(dict(self.options))


def paged(spark: SparkSession, folder: str, records_per_page: int) -> DataFrame:
    """page_offset, place (from 0 within the page) and record (JSON) of all pages of a folder, as a stream."""
    spark.dataSource.register(PagedSource)
    return spark.readStream.format("paged").option("records_per_page", records_per_page).load(folder)


def register_entries(records: DataFrame, states: list[str] | None = None) -> DataFrame:
    """Entries of a register from page_offset, place and record (JSON of one enterprise); a table or a stream.

    Records without a name or that aren't JSON are left out, as are those outside the states, where any are named. A code of other than six digits, perhaps with
    '.0' behind it, is null. Addresses that read as a home are marked: they are for verification, not to be published.
    """
    c = F.from_json("record", FIELDS)
    told = records.select(
        "page_offset", "place", clean(c["EnterpriseName"], 200).alias("name"), clean(c["State"], 80).alias("state"), clean(c["District"], 80).alias("district"), six_digit_code(clean(c["Pincode"], 1000), True).alias("code"),
        clean(c["CommunicationAddress"], 300).alias("address"), c["Activities"].alias("activities"), clean(c["RegistrationDate"], 20).alias("registered_on"),
    ).where("name IS NOT NULL")
    if states:
        told = told.where(F.upper("state").isin(*[s.upper() for s in states]))
    told = register_activities(told)
    home = F.col("residential")
    return told.select(
        F.lit("udyam").alias("registry"), F.concat(F.lit("udyam_offset_"), F.col("page_offset")).alias("source_file"), "place", "name", F.left(canon(F.col("name"), "udyam"), F.lit(200)).alias("canonical_name"),
        clean(F.col("trade"), 200).alias("nature"), clean(F.col("trade_code"), 8).alias("category_hint"), "district", "code", "address", "registered_on", F.lit("registered").alias("status"),
        F.to_json(F.struct("state", clean(F.col("trade_code"), 8).alias("nic"), home.alias("home_address_suspected")), {"ignoreNullFields": "false"}).alias("extra"),
    )


def load_register(spark: SparkSession, folder: str, out: str, checkpoint: str, records_per_page: int = 1000, states: list[str] | None = None) -> DataFrame:
    """Entries of all pages so far: only pages that no earlier run read are read, and each batch is written once.

    A run that follows one that was killed ends the batch that was open, with its pages; pages that came since are the next run's.
    """
    run_new(paged(spark, folder, records_per_page), lambda batch: register_entries(batch, states), out, checkpoint)
    return spark.read.parquet(out).drop("batch")
