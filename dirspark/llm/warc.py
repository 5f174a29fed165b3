"""WARC: records, and the resolution of not-modified revisits.

A server's 304 has no payload. Its full response is the latest earlier one of the same canonical URL. The join is as-of
in time and distributed: captures of a URL are cut into time buckets, each bucket's last full response is carried over the
buckets after it, and within a bucket a window does the rest. So a URL with a third of all captures is many small tasks.
The resolved response has the stored headers, renewed by those that a 304 may send.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.common import table

# Headers that a 304 may renew in a stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified", "age")
# Query parameters that only track.
TRACKING = r"^(utm_[a-z]+|ref|fbclid|gclid|sessionid)$"
BUCKET = 1024


def canonical_url(url: Column) -> Column:
    """Without scheme, leading www. or m., default port, fragment, tracking parameters and a slash at the end; parameters in order."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^(www|m)[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    parameters = F.filter(F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~F.rlike(F.element_at(F.split(p, "="), 1), F.lit(TRACKING)))
    text = F.array_join(F.array_sort(parameters), "&")
    return F.concat(host, path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")))


def merged_headers(stored: Column, sent: Column) -> Column:
    """Stored headers, with the permitted ones that the 304 sent in their place. Names are in lower case."""
    renew = F.map_filter(F.coalesce(sent, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(*PERMITTED) & v.isNotNull())
    keep = F.map_filter(F.coalesce(stored, F.create_map().cast("map<string,string>")), lambda k, v: ~F.map_contains_key(renew, k))
    return F.map_from_entries(F.array_sort(F.concat(F.map_entries(keep), F.map_entries(renew))))


def resolve_revisits(captures: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Each revisit with its response: record_id, original_id, verdict, headers.

    captures: record_id, url, seq (time as a long), kind ('response' or 'revisit'), headers (map with lower-case names). Verdicts:
    'resolved' where ETags agree, or Last-Modified where either lacks an ETag; 'no_validator' where there is nothing to compare;
    'changed' where they differ (the record then stays unresolved in fact, but names what it was compared with); 'missing' where no
    earlier response exists. Of responses at one time the largest record_id counts; a response at the revisit's own time
    isn't earlier. Null URLs, times and kinds match nothing: revisits among them are 'missing'.
    """
    c = F.col
    rows = captures.select("record_id", canonical_url(c("url")).alias("site"), "seq", "kind", "headers")
    wanted = rows.where((c("kind") == "revisit"))
    lost = wanted.where(c("site").isNull() | c("seq").isNull())
    usable = rows.where(c("site").isNotNull() & c("seq").isNotNull() & c("kind").isin("response", "revisit")).withColumn("slot", F.floor(c("seq") / bucket))
    # Only what is compared travels: validators, not payloads.
    full = usable.where(c("kind") == "response").groupBy("site", "slot").agg(F.max(F.struct("seq", "record_id")).alias("last"))
    slots = usable.select("site", "slot").distinct().join(full, ["site", "slot"], "left")
    earlier = Window.partitionBy("site").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("site", "slot", F.max("last").over(earlier).alias("carried"))
    # Within a bucket: responses strictly earlier, by a frame over time.
    before = Window.partitionBy("site", "slot").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    own = F.max(F.when(c("kind") == "response", F.struct("seq", "record_id"))).over(before)
    found = usable.withColumn("own", own).where(c("kind") == "revisit").join(carried, ["site", "slot"])
    found = found.select("record_id", "headers", F.coalesce(c("own.record_id"), c("carried.record_id")).alias("original_id"))
    stored = rows.where(c("kind") == "response").select(c("record_id").alias("original_id"), c("headers").alias("stored")).dropDuplicates(["original_id"])
    joined = found.join(stored, "original_id", "left").unionByName(lost.select("record_id", "headers", F.lit(None).cast(captures.schema["record_id"].dataType).alias("original_id"), F.lit(None).cast("map<string,string>").alias("stored")))
    a, b = F.get(F.array("stored"), F.lit(0)), c("headers")
    etags, dates = (a["etag"], b["etag"]), (a["last-modified"], b["last-modified"])
    verdict = (
        F.when(c("original_id").isNull(), "missing")
        .when(etags[0].isNotNull() & etags[1].isNotNull(), F.when(F.regexp_replace(etags[0], "^W/", "") == F.regexp_replace(etags[1], "^W/", ""), "resolved").otherwise("changed"))
        .when(dates[0].isNotNull() & dates[1].isNotNull(), F.when(dates[0] == dates[1], "resolved").otherwise("changed"))
        .otherwise("no_validator")
    )
    out = joined.withColumn("verdict", verdict)
    return out.select("record_id", "original_id", "verdict", F.when(c("verdict").isin("resolved", "no_validator"), merged_headers(c("stored"), c("headers"))).otherwise(c("headers")).alias("headers"))


def parse_records(files: DataFrame) -> DataFrame:
    """record_id, url, date, type, http headers (lower-case names) and payload of the records in WARC files (content binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = list(records(content.as_buffer().to_pybytes()))
                columns = zip(*out, strict=True) if out else [[]] * 6
                kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary())
                yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["record_id", "url", "date", "type", "headers", "payload"])

    return files.select("content").mapInArrow(run, "record_id string, url string, date string, type string, headers map<string,string>, payload binary")


def records(data: bytes) -> Iterator[tuple]:
    """The records of one uncompressed file; what isn't a record ends the file."""
    at = 0
    while (head := re.compile(rb"\s*WARC/1\.[01]\r\n").match(data, at)) and (end := data.find(b"\r\n\r\n", head.end())) >= 0:
        fields = named(data[head.end() : end])
        size = int(fields.get("content-length", 0))
        body = data[end + 4 : end + 4 + size]
        at = end + 4 + size
        top, _, payload = body.partition(b"\r\n\r\n") if body.startswith(b"HTTP/") else (b"", b"", body)
        yield fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-date"), fields.get("warc-type"), list(named(top.partition(b"\r\n")[2]).items()), payload


def named(block: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n"))
    return {k.strip().lower(): v.strip() for k, _, v in pairs if k.strip()}


def write_record(record_id: str, url: str, date: str, kind: str, status: str, headers: dict[str, str], payload: bytes = b"") -> bytes:
    http = f"HTTP/1.1 {status}\r\n".encode() + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers.items()) + b"\r\n" + payload
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {record_id}\r\nWARC-Target-URI: {url}\r\nWARC-Date: {date}\r\nContent-Length: {len(http)}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def page_captures(pages: DataFrame) -> DataFrame:
    """A capture log of the pages: each was fetched in full at ten times its id and asked for again five later, when its server sent a
    304 with a new date. Each sixth server has forgotten the page's ETag and sends another."""
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    first = pages.select(F.concat(F.lit("p:"), F.col("page_id")).alias("record_id"), "url", (F.col("page_id") * 10).alias("seq"), F.lit("response").alias("kind"), F.create_map(F.lit("etag"), tag, F.lit("date"), F.concat(F.lit("d"), F.col("page_id")), F.lit("content-type"), F.lit("text/html")).alias("headers"))
    sent = F.when(F.col("page_id") % 6 == 0, F.lit('"new"')).otherwise(tag)
    again = pages.select(F.concat(F.lit("r:"), F.col("page_id")).alias("record_id"), "url", (F.col("page_id") * 10 + 5).alias("seq"), F.lit("revisit").alias("kind"), F.create_map(F.lit("etag"), sent, F.lit("date"), F.concat(F.lit("e"), F.col("page_id")), F.lit("content-type"), F.lit("none")).alias("headers"))
    return first.unionByName(again)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's revisit, with the response that it stands for and its renewed headers as JSON."""
    out = resolve_revisits(page_captures(table(spark, sf_dir, "pages")))
    return out.select("record_id", "original_id", "verdict", F.col("headers")["date"].alias("date"), F.col("headers")["content-type"].alias("content_type"), F.col("headers")["etag"].alias("etag"))


ORACLE = r"""
WITH bare AS (SELECT page_id, html, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS b FROM pages),
parts AS (
  SELECT page_id, html, regexp_replace(regexp_replace(lower(regexp_extract(b, '^[^/?]*')), '^(www|m)[.]', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(b, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(b, '[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(string_split(p, '=')[1], '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)$'))), '&') AS query FROM bare),
sites AS (SELECT page_id, host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END AS site, '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS tag FROM parts),
joined AS (
  SELECT r.page_id, r.tag AS own_tag, CASE WHEN r.page_id % 6 = 0 THEN '"new"' ELSE r.tag END AS sent, s.page_id AS original, s.tag AS tag
  FROM sites r ASOF LEFT JOIN sites s ON r.site = s.site AND r.page_id * 10 + 5 > s.page_id * 10)
SELECT 'r:' || page_id AS record_id, 'p:' || original AS original_id, CASE WHEN original IS NULL THEN 'missing' WHEN sent = tag THEN 'resolved' ELSE 'changed' END AS verdict,
  'e' || page_id AS date, CASE WHEN sent = tag THEN 'text/html' ELSE 'none' END AS content_type, sent AS etag FROM joined
"""
