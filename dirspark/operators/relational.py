"""Relational building blocks with defined ties: every order ends in a unique key."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """DISTINCT ON: the first row of each key."""
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "_rn") -> DataFrame:
    """The first k rows of each key; Spark prunes to k per task before it shuffles."""
    rows = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)
    return rows.drop(rank) if rank == "_rn" else rows


def share_of_total(df: DataFrame, by: str) -> DataFrame:
    """n and percent of all rows for each value, to two places."""
    n = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def mode(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """The most frequent value of each key; ties go to the smallest."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return first_per_key(counts, [key], [F.col("_n").desc(), F.col(value).asc()]).select(key, F.col(value).alias(alias))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows, and non-null counts of the columns, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"n_{c}") for c in columns])


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return out.orderBy(F.col("n").desc(), F.col(column).asc()).limit(limit) if limit else out


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: list[str] = ()) -> DataFrame:
    """ON CONFLICT DO UPDATE: new rows replace old ones; columns in keep_old keep the old value where the new is null."""
    o, n = old.alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full")
    columns = []
    for c in old.columns:
        both = F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        columns.append((both if c in keys or c in keep_old else F.when(F.col("n._new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))).alias(c))
    return joined.select(*columns)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """ON CONFLICT DO NOTHING."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def record_filter(codes: list[str] | None = None, city: str | None = None, district: str | None = None, state: str | None = None, categories: list[str] | None = None, tiers: list[str] | None = None, least: dict[str, float] | None = None) -> Column:
    """The conjunction that a user's choices stand for. City, district and state match whole, whatever the case."""
    conditions = [F.col("code").isin(codes)] if codes else []
    conditions += [F.col(c).ilike(v) for c, v in (("city", city), ("district", district), ("state", state)) if v]
    conditions += [F.col(c).isin(v) for c, v in (("category", categories), ("tier", tiers)) if v]
    conditions += [F.col(c) >= v for c, v in (least or {}).items()]
    return all_of(conditions)


def fixed(df: DataFrame) -> DataFrame:
    """df written once to the checkpoint folder that all executors share."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); a local one only where none is set, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/dirspark-checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below it."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def components(links: DataFrame) -> DataFrame:
    """node and label, the smallest node reachable, for all nodes of links(a, b).

    Each round a node takes the smallest label next to it, and then its label's own label, so paths halve. Rounds are checkpointed.
    """
    both = fixed(links.select("a", "b").union(links.select("b", "a")).toDF("node", "near").distinct())
    labels = fixed(both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), F.col("label").alias("m")), "near").groupBy("node").agg(F.min("m").alias("m"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        done = fixed(lower.join(jump, "label", "left").select("node", "old", F.coalesce(F.least("label", "further"), "label").alias("label")))
        labels = done.select("node", "label")
        if done.where("label <> old").isEmpty():
            return labels


def arbitrary_per_key(rows: DataFrame, key: str, column: str) -> DataFrame:
    """One value of column for each key: the smallest that isn't null, so that reruns agree."""
    return rows.groupBy(key).agg(F.min(column).alias(column))


def missing_keys(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """The required keys that are not present, each once."""
    return required.select(key).where(F.col(key).isNotNull()).distinct().join(present.select(key).distinct(), key, "left_anti")
