"""Sinks: export bundles with manifest and checksums. Files are written by executors; the driver sees totals only."""

from __future__ import annotations

import hashlib
import json
import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from dirspark.operators.directory import export_order, manifest_sources, manifest_values
from dirspark.sources.pbf import opened

CHUNK = 4 << 20
# What a manifest says of every export.
DEFAULTS = {
    "claim_status": "unclaimed", "verification_status": "unverified", "publication_type": "directory_listing", "products_disabled": True, "offers_disabled": True,
    "reviews_disabled": True, "owner_contact_unconfirmed": True,
}
NOTES = (
    "Directory listings. Not owner-verified. Nothing inferred or fabricated.", "Absent fields are null and must stay absent.",
    "location_accuracy governs display: 'locality' records must not show a distance.",
)


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def geojson_lines(records: DataFrame) -> DataFrame:
    """One feature for each row; longitude first, and positions not repeated among the properties."""
    properties = F.struct(*[c for c in records.columns if c not in ("latitude", "longitude")])
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")).alias("geometry"), properties.alias("properties"))
    return records.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_records(records: DataFrame, path: str, form: str, single_file: bool = False) -> None:
    """csv, jsonl, json or geojson. single_file is for hand-sized bundles that must be one file."""
    ordered = export_order(records)
    one = (lambda d: d.coalesce(1)) if single_file else (lambda d: d)
    if form == "csv":
        one(ordered).write.mode("overwrite").option("header", True).csv(path)
    elif form == "jsonl":
        one(ordered).write.mode("overwrite").option("ignoreNullFields", False).json(path)
    elif form in ("json", "geojson"):
        items = geojson_lines(ordered) if form == "geojson" else ordered.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        one(items).write.mode("overwrite").text(path)
    else:
        raise ValueError(form)


def in_order(parts: list[pafs.FileInfo]) -> list[pafs.FileInfo]:
    """Data files of a folder by their number."""
    numbered = [(int(m[1]), x.path, x) for x in parts if x.type == pafs.FileType.File and (m := re.match(r"part-(\d+)", x.base_name))]
    return [x for _, _, x in sorted(numbered, key=lambda t: t[:2])]


def chunks(fs: pafs.FileSystem, paths: list[str], size: int = CHUNK) -> Iterator[bytes]:
    for path in paths:
        with fs.open_input_stream(path) as f:
            while data := f.read(size):
                yield data


def with_separators(data: Iterable[bytes], separator: bytes) -> Iterator[bytes]:
    """Lines with a separator between them instead of line feeds, and none at the end."""
    ended = False
    for x in data:
        if ended:
            yield separator
        ended = x.endswith(b"\n")
        yield x[: len(x) - ended].replace(b"\n", separator)


def joined_parts(spark: SparkSession, parts: str, path: str, form: str, header: str = "") -> Row:
    """One file of a folder's parts, in their order: its name, n_bytes and sha256.

    A document is one file, so one task writes it: chunk by chunk, whatever its size, with the checksum taken on the way. Nothing passes through the
    driver. The file gets its name when it is whole; a task that is repeated writes the same bytes again.
    """
    before, after = {"json": ("[\n", "\n]\n"), "geojson": ('{"type":"FeatureCollection","features":[\n', "\n]}\n")}.get(form, (header, ""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            (fs, source), (_, target) = opened(parts), opened(path)
            body = chunks(fs, [x.path for x in in_order(fs.get_file_info(pafs.FileSelector(source)))])
            digest, n = hashlib.sha256(), 0
            folder, name = posixpath.split(target)
            fs.create_dir(folder, recursive=True)
            hidden = posixpath.join(folder, f".{name}.{uuid.uuid4().hex}")
            with fs.open_output_stream(hidden) as out:
                for x in chain([before.encode()], with_separators(body, b",\n") if after else body, [after.encode()]):
                    out.write(x)
                    digest.update(x)
                    n += len(x)
            if fs.get_file_info(target).type == pafs.FileType.File:
                fs.delete_file(target)
            fs.move(hidden, target)
            yield pd.DataFrame({"file": [name], "n_bytes": [n], "sha256": [digest.hexdigest()]})

    return spark.range(1, numPartitions=1).mapInPandas(run, "file string, n_bytes long, sha256 string").first()


def write_document(records: DataFrame, path: str, form: str) -> Row:
    """Records in the order of exports as one file (csv, jsonl, json or geojson) with its name, n_bytes and sha256. The parts stay below path.parts."""
    parts, ordered = f"{path}.parts", export_order(records)
    if form == "csv":
        ordered.write.mode("overwrite").option("escape", '"').option("lineSep", "\n").csv(parts)
    elif form in ("jsonl", "json", "geojson"):
        lines = geojson_lines(ordered) if form == "geojson" else ordered.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
        lines.write.mode("overwrite").text(parts)
    else:
        raise ValueError(form)
    return joined_parts(records.sparkSession, parts, path, form, ",".join(records.columns) + "\n" if form == "csv" else "")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of each data file below path, read chunk by chunk: files may have any size."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for file in batch["path"]:
                digest, (fs, inner) = hashlib.sha256(), opened(file)
                for x in chunks(fs, [inner]):
                    digest.update(x)
                out.append((posixpath.basename(inner), digest.hexdigest()))
            yield pd.DataFrame(out, columns=["file", "sha256"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    return files.mapInPandas(run, "file string, sha256 string")


def manifest(records: DataFrame, excluded: DataFrame, as_of: str, **told: object) -> str:
    """What an export holds and what it leaves out, as JSON; told has what the records can't say (export_id, schema_version, created_by, format, filters, data_file, sha256)."""
    values, reasons = manifest_values(records).first().asDict(), excluded.first().asDict()
    sources = [r.asDict() for r in manifest_sources(records).orderBy(F.desc("n"), "source_name", "licence_name", "attribution_text").collect()]
    reasons = {k: v for k, v in reasons.items() if v}
    content = {
        "created_at": as_of,
        "record_count": sum(r["n"] for r in sources),
        "excluded_count": sum(reasons.values()),
        "exclusion_reasons": reasons,
        "source_summary": [{"source": r["source_name"], "licence": r["licence_name"], "attribution": r["attribution_text"], "records": r["n"]} for r in sources],
        "licence_summary": sorted({r["licence_name"] or "unknown" for r in sources}),
        "attribution_requirements": [x for x in values["attribution_text"] or [] if x],
        "pincodes": [x for x in values["pincode"] or [] if x],
        "categories": [x for x in values["category"] or [] if x],
        "defaults_applied": DEFAULTS,
        "notes": list(NOTES),
    }
    return json.dumps(content | told, ensure_ascii=False, sort_keys=True, indent=1)


def write_bundle(records: DataFrame, excluded: DataFrame, folder: str, form: str, as_of: str, export_id: str, by: str, filters: dict | None = None, schema_version: str = "1") -> Row:
    """data.<form>, manifest.json, ATTRIBUTION.txt and SHA256SUMS in a folder; the file's name, n_bytes and sha256."""
    done = write_document(records, f"{folder}/data.{form}", form)
    content = manifest(records, excluded, as_of, export_id=export_id, schema_version=schema_version, created_by=by, format=form, filters={k: v for k, v in (filters or {}).items() if v}, data_file=done.file, sha256=done.sha256)
    fs, inner = opened(folder)
    for name, text in (("manifest.json", content), ("ATTRIBUTION.txt", attribution(records) + "\n"), ("SHA256SUMS", f"{done.sha256}  {done.file}\n")):
        with fs.open_output_stream(posixpath.join(inner, name)) as f:
            f.write(text.encode())
    return done


def attribution(records: DataFrame) -> str:
    """The distinct attribution lines of all records, sorted: a line for each source."""
    return "\n".join(manifest_values(records).first().attribution_text or [])


def ledger(records: DataFrame, export_id: str, sha256: str) -> tuple[DataFrame, DataFrame]:
    """The export's own row and a row for each record in it, to be appended."""
    head = records.agg(F.lit(export_id).alias("export_id"), F.count(F.lit(1)).alias("n"), F.lit(sha256).alias("sha256"), F.lit("complete").alias("status"))
    return head, records.select(F.lit(export_id).alias("export_id"), F.col("external_directory_id").alias("external_id"))
