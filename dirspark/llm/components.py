"""Connected components of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dirspark.llm.common import settle


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node and label (the smallest node reachable) for all nodes of links(a, b).

    known: labels from fewer links, to start from; links then join labels, and only what changes is found anew.
    In each round a label takes the smallest label next to it and then its label's label, so
    that paths halve; rows that have settled cost a scan of two numbers each.
    """
    if known is not None:
        of = lambda c: known.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
        lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b"))
        new = components(lifted.where("a <> b").distinct())
        over = new.select(F.col("node").alias("label"), F.col("label").alias("new_label"))
        moved = known.join(over, "label", "left").select("node", F.coalesce("new_label", "label").alias("label"))
        return settle(moved.unionByName(new.join(known.select("node"), "node", "left_anti")), "labels")
    both = settle(links.select("a", "b").union(links.select("b", "a")).toDF("node", "near"), "edges")
    labels = settle(both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), F.col("label").alias("m")), "near").groupBy("node").agg(F.min("m").alias("m"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        done = settle(lower.join(jump, "label", "left").select("node", "old", F.coalesce(F.least("label", "further"), "label").alias("label")), "labels")
        labels = done.select("node", "label")
        if done.where("label <> old").isEmpty():
            return labels
