"""Sources: JSON lines, nested Parquet, postal TSV, CSV of unknown encoding and tag maps."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark import constants as C
from dirspark.functions.contact import looks_residential
from dirspark.functions.geo import BOX
from dirspark.functions.wkb import wkb_centroid

# Tag values that make a place a business, prefixes and keys of tags that are kept, and kinds of places.
AMENITIES = (
    "restaurant", "cafe", "fast_food", "bar", "pub", "ice_cream", "food_court", "biergarten", "pharmacy", "clinic", "hospital", "doctors", "dentist", "veterinary", "nursing_home",
    "bank", "bureau_de_change", "atm", "fuel", "charging_station", "car_wash", "car_rental", "driving_school", "school", "college", "university", "kindergarten", "language_school",
    "music_school", "library", "cinema", "theatre", "nightclub", "marketplace", "internet_cafe", "coworking_space", "post_office", "courier", "money_transfer", "payment_centre",
    "vehicle_inspection", "training", "childcare", "studio", "photo_booth", "printer",
)
TOURISM = ("hotel", "guest_house", "motel", "hostel", "apartment", "chalet", "resort")
LEISURE = ("fitness_centre", "sports_centre", "swimming_pool", "dance", "gym", "spa", "amusement_arcade", "bowling_alley", "escape_game", "adult_gaming_centre")
KEPT_PREFIXES = ("addr:", "contact:", "payment:", "service:", "diet:")
KEPT_KEYS = (
    "name", "name:en", "name:hi", "name:te", "int_name", "alt_name", "old_name", "brand", "brand:wikidata", "operator", "operator:type", "shop", "amenity", "office", "craft",
    "healthcare", "healthcare:speciality", "tourism", "leisure", "club", "cuisine", "phone", "mobile", "email", "website", "url", "fax", "opening_hours", "opening_hours:covid19",
    "delivery", "takeaway", "drive_through", "outdoor_seating", "wheelchair", "internet_access", "air_conditioning", "smoking", "organic", "second_hand", "self_service", "wholesale",
    "building", "building:levels", "level", "description", "note", "source", "check_date", "survey:date", "start_date", "ref", "gst:number", "website:menu", "facebook", "instagram",
    "whatsapp", "payment:cash", "stars", "rooms", "capacity", "denomination",
)
PLACE_KINDS = ("city", "town", "municipality", "suburb", "village", "neighbourhood", "quarter", "hamlet", "borough", "locality")
ENCODINGS = ("utf-8-sig", "cp1252", "latin-1")

TAGGED = "osm_type string, osm_id long, lat double, lon double, timestamp timestamp, tags map<string,string>"
POSTAL = "country string, code string, place string, state string, state_code string, district string, district_code string, mandal string, mandal_code string, lat string, lon string, accuracy string"


def json_lines(spark: SparkSession, path: str, schema: str = TAGGED) -> DataFrame:
    """Malformed lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def places_parquet(spark: SparkSession, path: str, country: str = "IN", box: tuple[float, float, float, float] = BOX) -> DataFrame:
    """Nested place records: filters on the bounding box and fields read reach the Parquet scan. A place lies at its geometry's centroid; the middle of its box stands in for a geometry that is missing or broken."""
    rows = spark.read.parquet(path).where(F.col("bbox.ymin").between(box[0], box[1]) & F.col("bbox.xmin").between(box[2], box[3]) & F.col("names.primary").isNotNull())
    first = F.try_element_at("addresses", F.lit(1))
    lat, lon = (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2, (F.col("bbox.xmin") + F.col("bbox.xmax")) / 2
    if "geometry" in rows.columns:
        centre = wkb_centroid("geometry")
        lat, lon = F.coalesce(centre["lat"], lat), F.coalesce(centre["lon"], lon)
    return rows.where(first["country"] == country).select(
        "id", F.col("names.primary").alias("name"), F.col("categories.primary").alias("category"), F.col("categories.alternate").alias("category_alt"), "phones", "websites", "confidence",
        first["freeform"].alias("address"), first["locality"].alias("locality"), first["postcode"].alias("postcode"), lat.alias("lat"), lon.alias("lon"),
    )


def postal_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Offices with a position, in file order (seq)."""
    rows = spark.read.schema(POSTAL).option("sep", "\t").option("quote", "").csv(path).where("lat IS NOT NULL AND lat <> '' AND lon IS NOT NULL AND lon <> ''")
    return rows.select("code", "place", "state", "district", "mandal", F.col("lat").try_cast("double").alias("lat"), F.col("lon").try_cast("double").alias("lon"), F.monotonically_increasing_id().alias("seq"))


def decoded(raw: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise AssertionError("latin-1 decodes anything")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, seq and record (trimmed values by trimmed header, empty ones left out) of CSV files in UTF-8 or a western encoding.

    Each file is decoded and read by itself, with its own header; quoted values may hold line breaks. Row -1 of a file has the place of each
    name in its header. Files should be of register size: one is read whole. A line longer than the header loses what goes beyond it.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        csv.field_size_limit(1 << 31)
        for part in parts:
            for file, content in zip(part["path"], part["content"], strict=True):
                lines = csv.reader(io.StringIO(decoded(content), newline=""))
                header = [x.strip() for x in next(lines, [])]
                rows = [{h: v.strip() for h, v in zip(header, line, strict=False) if h and v.strip()} for line in lines if any(x.strip() for x in line)]
                rows.insert(0, {h: str(i) for i, h in enumerate(header) if h})
                for at in range(0, len(rows), 10_000):
                    some = rows[at : at + 10_000]
                    yield pd.DataFrame({"file": [file] * len(some), "seq": range(at - 1, at - 1 + len(some)), "record": some})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "file string, seq long, record map<string,string>")


def csv_any_encoding(spark: SparkSession, path: str) -> DataFrame:
    """The same as columns: one for each name that a header of a file has, in the order of the headers. Only names come to the driver."""
    rows = csv_records(spark, path)
    names = rows.where("seq < 0").select(F.explode("record").alias("name", "place")).groupBy("name").agg(F.min(F.col("place").cast("int")).alias("place")).orderBy("place", "name").collect()
    return rows.where("seq >= 0").select(*[F.col("record")[r.name].alias(r.name) for r in names])


def trimmed(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c.strip()) for c in df.columns])


def pick(df: DataFrame, *names: str) -> Column:
    """The first non-empty value among columns of these names, whatever their case."""
    have = {c.strip().lower(): c for c in df.columns}
    found = [F.nullif(F.trim(F.col(f"`{have[n.lower()]}`")), F.lit("")) for n in names if n.lower() in have]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def without_personal_columns(df: DataFrame) -> DataFrame:
    """Columns are judged by their name alone, and the pattern is broad."""
    return df.drop(*[c for c in df.columns if re.search(C.PERSONAL, c)])


def row_as_json(df: DataFrame) -> Column:
    """A row's non-blank values as JSON."""
    pairs = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))])
    return F.to_json(F.map_filter(pairs, lambda k, v: v.isNotNull() & (F.trim(v) != "")))


def is_business(tags: Column) -> Column:
    """A name, and a tag that makes it a business."""
    some = reduce(lambda a, b: a | b, [F.coalesce(tags[k], F.lit("")) != "" for k in ("shop", "office", "craft", "healthcare")])
    listed = F.coalesce(tags["amenity"].isin(*AMENITIES), F.lit(False)) | F.coalesce(tags["tourism"].isin(*TOURISM), F.lit(False)) | F.coalesce(tags["leisure"].isin(*LEISURE), F.lit(False))
    return (F.coalesce(tags["name"], F.lit("")) != "") & (some | listed)


def is_place(tags: Column) -> Column:
    return F.coalesce(tags["place"].isin(*PLACE_KINDS), F.lit(False)) & (F.coalesce(tags["name"], F.lit("")) != "")


def kept_tags(tags: Column) -> Column:
    return F.map_filter(tags, lambda k, v: k.isin(*KEPT_KEYS) | F.rlike(k, F.lit("^(" + "|".join(KEPT_PREFIXES) + ")")))


def register_activities(df: DataFrame, column: str = "activities") -> DataFrame:
    """First activity's description and code from a JSON list, and, where there is an address, whether it looks like a home."""
    items = F.from_json(column, "array<struct<Description:string,NIC5DigitId:string>>")
    first = F.try_element_at(items, F.lit(1))
    told = {"trade": first["Description"], "trade_code": first["NIC5DigitId"]}
    if "address" in df.columns:
        told["residential"] = F.coalesce(looks_residential(F.col("address")), F.lit(False))
    return df.withColumns(told)


def catalogue_files(catalogue: DataFrame, wanted: list[str], each: int) -> DataFrame:
    """CSV resources (title, format, url) of wanted titles, at most so many for each."""
    from dirspark.operators.relational import top_per_key

    names = F.array(*[F.lit(w) for w in wanted])
    hit = F.try_element_at(F.filter(names, lambda w: F.contains(F.lower("title"), F.lower(w))), F.lit(1))
    rows = catalogue.where(F.lower("format") == "csv").withColumn("dataset", hit).where("dataset IS NOT NULL")
    return top_per_key(rows, ["dataset"], [F.col("url").asc()], each)
