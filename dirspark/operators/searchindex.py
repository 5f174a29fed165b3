"""A persisted inverted index of a directory: written once, then searched by reading the lists of a query's terms only.

Below a folder lie three tables. postings: a row for each word and each trigram of a name in each record, with its weight, the record's position and number of trigrams, in folders by
kind, impact (whether the word stands in the name) and shard of the term, sorted by term, so that a scan reads few files and few of their row groups. terms: how many
records have each. records: what is shown, in folders by bucket of the id.
"""

from __future__ import annotations

import math
import re
import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.functions.geo import KM_PER_DEGREE, haversine
from dirspark.functions.text import gram_similarity, tokens, trigrams

NAME, OTHER = 4, 2
SHARDS = 64


def shard_of(term: Column, shards: int) -> Column:
    return (F.crc32(F.encode(term, "UTF-8")) % shards).cast("int")


def query_words(query: str) -> list[str]:
    """The distinct words of a query, in its order."""
    return list(dict.fromkeys(w for w in re.split("[^a-z0-9]+", query.lower()) if w))


def query_grams(query: str) -> list[str]:
    """Its distinct trigrams, as trigrams() makes them."""
    padded = [f"  {w} " for w in re.split("[^a-z0-9]+", query.lower()) if w]
    return list(dict.fromkeys(w[i : i + 3] for w in padded for i in range(len(w) - 2)))


def build_index(rows: DataFrame, path: str, shards: int = SHARDS, name: str = "display_name", others: tuple[str, ...] = ("category", "locality")) -> None:
    """Write the index of rows (external_id, lat, lon and the columns searched) below path.

    A common term's list is split over tasks, since they are dealt by ranges of term and id. Rows without words have a record, but no postings.
    """
    base = rows.select("external_id", "lat", "lon", F.col(name).alias("_name"), F.concat_ws(" ", *others).alias("_other"))
    base = base.withColumns({"_a": F.coalesce(F.array_distinct(tokens(F.col("_name"))), F.array().cast("array<string>")), "_b": F.array_distinct(tokens(F.col("_other"))), "_g": F.coalesce(trigrams(F.col("_name")), F.array().cast("array<string>"))})
    base = base.withColumn("n_grams", F.size("_g"))
    both = F.concat(
        F.transform(F.array_union("_a", "_b"), lambda w: F.struct(F.lit("word").alias("kind"), w.alias("term"), (F.when(F.array_contains("_a", w), NAME).otherwise(0) + F.when(F.array_contains("_b", w), OTHER).otherwise(0)).alias("weight"))),
        F.transform("_g", lambda g: F.struct(F.lit("gram").alias("kind"), g.alias("term"), F.lit(0).alias("weight"))),
    )
    told = base.select("external_id", "lat", "lon", "n_grams", F.inline(both))
    told = told.withColumns({"impact": F.when(F.col("weight") >= NAME, "name").otherwise("other"), "shard": shard_of(F.col("term"), shards)})
    told.repartitionByRange("kind", "impact", "shard", "term", "external_id").sortWithinPartitions("kind", "impact", "shard", "term", "external_id").write.mode("overwrite").partitionBy("kind", "impact", "shard").parquet(f"{path}/postings")
    spark = rows.sparkSession
    postings = spark.read.parquet(f"{path}/postings")
    postings.groupBy("kind", "shard", "term").agg(F.count(F.lit(1)).alias("n")).repartition("shard").sortWithinPartitions("kind", "shard", "term").write.mode("overwrite").partitionBy("kind", "shard").parquet(f"{path}/terms")
    rows.withColumn("bucket", shard_of(F.col("external_id"), shards)).repartition("bucket", F.crc32(F.encode("external_id", "UTF-8")) % 8).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/records")


class SearchIndex:
    """An index that build_index wrote."""

    def __init__(self, spark: SparkSession, path: str, shards: int = SHARDS):
        self.spark, self.path, self.shards = spark, path, shards

    def lists(self, table: str, kind: str, terms: list[str]) -> DataFrame:
        """The rows of some terms. Shards are literals, so other folders aren't listed among the files read."""
        shards = sorted({zlib.crc32(t.encode()) % self.shards for t in terms})
        return self.spark.read.parquet(f"{self.path}/{table}").where((F.col("kind") == kind) & F.col("shard").isin(shards) & F.col("term").isin(terms))

    def counts(self, kind: str, terms: list[str]) -> dict[str, int]:
        """How many records have each of a query's terms: as many numbers as the query has terms."""
        found = {r.term: r.n for r in self.lists("terms", kind, terms).collect()}
        return {t: found.get(t, 0) for t in terms}

    def near(self, postings: DataFrame, point: tuple[float, float] | None, km: float) -> DataFrame:
        """Postings within km of the point, with d_km (null without a point). A box around the circle goes to the scan."""
        if point is None:
            return postings.withColumn("d_km", F.lit(None).cast("double"))
        lat, lon = point
        high = km / KM_PER_DEGREE
        wide = high / max(math.cos(math.radians(min(abs(lat) + high, 89.0))), 1e-3)
        boxed = postings.where(F.col("lat").between(lat - high, lat + high))
        if lon - wide >= -180 and lon + wide <= 180:
            boxed = boxed.where(F.col("lon").between(lon - wide, lon + wide))
        return boxed.withColumn("d_km", haversine(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))).where(F.col("d_km") <= km)

    def matches(self, words: list[str], point: tuple[float, float] | None = None, km: float = 10.0, impact: str | None = None) -> DataFrame:
        """external_id, rank and d_km of all records that hold all words; with impact, of those that hold all of them so.

        The rarest word's list is met first and the others only where it has the record.
        """
        n = self.counts("word", words)
        order = sorted(words, key=lambda w: (n[w], w))

        def postings(terms: list[str]) -> DataFrame:
            found = self.lists("postings", "word", terms)
            return self.near(found if impact is None else found.where(F.col("impact") == impact), point, km).select("external_id", "weight", "d_km")

        hits = postings(order[:1]).withColumnRenamed("weight", "rank")
        if len(order) > 1:
            rest = postings(order[1:]).groupBy("external_id").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")).where(F.col("n") == len(order) - 1)
            hits = hits.join(rest.select("external_id", "weight"), "external_id").select("external_id", (F.col("rank") + F.col("weight")).alias("rank"), "d_km")
        return hits.select("external_id", F.col("rank").cast("double").alias("rank"), "d_km")

    def alike(self, query: str, least: float, point: tuple[float, float] | None = None, km: float = 10.0) -> DataFrame:
        """external_id, rank (the similarity of trigrams) and d_km of records whose name is at least so similar.

        A record that similar has so many of the query's m trigrams that it must be in one of the m - ceil(least * m) + 1 rarest lists; the number of its own is
        bounded both ways. What these let through is verified on whole names.
        """
        grams = query_grams(query)
        m = len(grams)
        n = self.counts("gram", grams)
        rare = sorted(grams, key=lambda g: (n[g], g))[: m - math.ceil(least * m - 1e-9) + 1]
        found = self.lists("postings", "gram", rare).where(F.col("n_grams").between(math.ceil(least * m - 1e-9), math.floor(m / least + 1e-9)))
        found = self.near(found, point, km).select("external_id", "d_km").distinct()
        told = found.withColumn("bucket", shard_of(F.col("external_id"), self.shards)).join(self.spark.read.parquet(f"{self.path}/records").select("bucket", "external_id", "display_name"), ["bucket", "external_id"])
        rank = gram_similarity(trigrams(F.col("display_name")), F.array(*[F.lit(g) for g in grams]))
        return told.withColumn("rank", rank).where(F.col("rank") >= least).select("external_id", "rank", "d_km")

    def search(self, query: str, limit: int = 20, offset: int = 0, point: tuple[float, float] | None = None, km: float = 10.0, least: float = 0.3) -> DataFrame:
        """external_id, rank and d_km of a page of hits, by rank, nearness and id.

        Lists of names come first: a record that lacks a word there has at most OTHER for it and NAME + OTHER for each other word. If
        the page is full and its last rank is above that, the other lists are not read. Only where no record holds all words, and the query has four characters or more,
        similar names are looked for. A query without words has no hits.
        """
        words = query_words(query)
        ordered = lambda df: df.orderBy(F.col("rank").desc(), "d_km", "external_id").offset(offset).limit(limit)
        if not words:
            return self.spark.createDataFrame([], "external_id string, rank double, d_km double")
        bound = (NAME + OTHER) * (len(words) - 1) + OTHER
        last = self.matches(words, point, km, "name").orderBy(F.col("rank").desc(), "d_km", "external_id").offset(offset + limit - 1).limit(1).collect()
        if last and last[0].rank > bound:
            return ordered(self.matches(words, point, km, "name"))
        hits = self.matches(words, point, km)
        if not hits.isEmpty() or len(query) < 4:
            return ordered(hits)
        return ordered(self.alike(query, least, point, km))

    def found(self, query: str, point: tuple[float, float] | None = None, km: float = 10.0) -> DataFrame:
        """One row: the number of all records that hold all words."""
        return self.matches(query_words(query), point, km).agg(F.count(F.lit(1)).alias("n_found"))

    def shown(self, page: DataFrame) -> DataFrame:
        """A page with its records' columns: only their buckets are read."""
        records = self.spark.read.parquet(f"{self.path}/records")
        told = page.withColumn("bucket", shard_of(F.col("external_id"), self.shards))
        return told.join(records.drop("lat", "lon"), ["bucket", "external_id"]).drop("bucket")
