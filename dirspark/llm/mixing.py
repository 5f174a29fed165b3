"""Mixing sources to target weights.

Each source gets a budget of words. Its documents are put in the order of a hash key, the words
before each document are a prefix sum, and the budget cuts the order at an exact word. A budget
above the size of the source repeats whole epochs first.

Prefix sums are distributed: the key space of a source is cut into ranges in proportion to its
number of documents, ranges are sorted by themselves, and range totals give each range its
offset. A source with a third of all rows is thus many small tasks. Everything here is built-in
functions; sums are of integers, so that reruns and other partitionings agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.common import documents, nullsafe, settle, text_of, word_count, words_of

#: Documents in a range of keys, about.
RANGE_ROWS = 2000
MAX_EPOCHS = 3
SEED = "mix-1"


def cycle_weights(n: int = 3) -> Column:
    """Weights 1..n in turn, in the order of the source names (code points, null last)."""
    return ((F.col("source_rank") - 1) % n + 1).cast("double")


def source_budgets(sized: DataFrame, weight: Column | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row for each source: its size, target and number of key ranges.

    Targets share the total by weight. None exceeds max_epochs times its source's size; what is
    cut off goes to the others by weight. Sources in the order of cap over weight fill up one
    after another, so the level at which the rest settle is found with prefix sums, not a loop.
    The table has a row for each source of the mixture, a list that is configured by hand.
    """
    weight = cycle_weights() if weight is None else weight
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    named = Window.orderBy(F.col("source").isNull(), "source")
    ranked = total.withColumn("source_rank", F.row_number().over(named)).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", (F.lit(max_epochs) * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    everything, before = Window.partitionBy(), Window.orderBy("ratio", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    levelled = ranked.withColumns(
        {
            "left_words": F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "left_weight": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    ).withColumn("level", F.col("left_words") / F.col("left_weight"))
    # The first source, in this order, whose cap is not below the level: it and all later ones settle there.
    settled = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_rank", "level"))).over(everything)
    levelled = levelled.withColumn("settled", settled)
    target = F.when(F.col("ratio") < F.col("settled.level"), F.col("cap")).otherwise(F.least(F.col("weight") * F.col("settled.level"), F.col("cap")))
    return levelled.select(
        nullsafe("source").alias("source_key"),
        "source_size",
        F.coalesce(target, F.col("cap")).alias("target"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / F.lit(RANGE_ROWS))).cast("long").alias("n_ranges"),
    )


def with_key(docs: DataFrame, seed: str) -> DataFrame:
    """Adds size (words), source_key and the hash-random mix_key (16 hex digits): of the doc_id, or of the text where that is null."""
    key = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text_of()))))), 1, 16)
    return docs.withColumns({"size": word_count(text_of()), "source_key": nullsafe("source"), "mix_key": key})


def plan_mix(docs: DataFrame, carry: list[str], weight: Column | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix's decision on each row: size, source_size, target, taken, and the columns in carry.

    taken is the number of words that the mix takes, whole epochs counted each: size times the
    epochs, plus what of the row lies before the cut of the last epoch.

    Null and empty texts have size 0 and take 0. A null source is a source of its own, the last
    one. Null and repeated doc_ids are rows like others: rows with equal keys are ordered by size and
    by a hash of the text. An empty table gives an empty plan. Only doc_id, text, source and
    carry are read; other columns don't matter.
    """
    sized = settle(with_key(docs.select("doc_id", "text", "source"), seed).select("doc_id", "source", "source_key", "size", "mix_key"), "sized")
    sources = settle(source_budgets(sized, weight, max_epochs), "sources")
    # The key's first 32 bits, scaled to the number of ranges, keep the key's order.
    in_range = F.expr("cast(conv(substring(mix_key, 1, 8), 16, 10) as bigint) * n_ranges div 4294967296").alias("key_range")
    ranges = sized.join(sources.select("source_key", "n_ranges"), "source_key").groupBy("source_key", in_range).agg(F.sum("size").alias("range_words"))
    earlier = Window.partitionBy("source_key").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source_key", "key_range", F.coalesce(F.sum("range_words").over(earlier), F.lit(0)).alias("range_start"))
    if set(carry) <= {"doc_id", "source"}:
        rows, tie = sized, []
    else:
        # The text itself goes no further than its count and hash, unless it is carried.
        kept = with_key(docs.select(*dict.fromkeys(["doc_id", "text", "source", *carry])), seed).withColumn("mix_tie", F.xxhash64(text_of()))
        rows, tie = kept.select(*dict.fromkeys(["doc_id", "source_key", "size", "mix_key", "mix_tie", *carry])), ["mix_tie"]
    rows = rows.join(sources, "source_key").withColumn("key_range", in_range)
    before = Window.partitionBy("source_key", "key_range").orderBy("mix_key", "doc_id", "size", *tie).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("words_before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = rows.join(offsets, ["source_key", "key_range"]).withColumn("words_before", F.col("words_before") + F.col("range_start"))
    budget = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5D) as bigint) div greatest(source_size, 1L)")).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    part = F.least(F.greatest(F.col("rest") - F.col("words_before"), F.lit(0)), F.col("size"))
    return rows.withColumn("part", part).select(*carry, "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part")


def mix(docs: DataFrame, weight: Column | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus, with the columns of docs: a row for each epoch that takes a document.

    The document at a budget's edge is cut after its last word taken. Rows of size 0 are taken by
    no mix. Columns named like this module's own are kept apart in a struct while the plan is made;
    n_chars, where there is such a column, follows a cut text.
    """
    names = docs.columns
    packed = docs.select("doc_id", "text", "source", F.struct(*names).alias("mixed_row"))
    plan = plan_mix(packed, ["mixed_row"], weight, max_epochs, seed)
    copies = F.when(F.col("epochs") > 0, F.array_repeat(F.col("size"), F.col("epochs").cast("int"))).otherwise(F.expr("array(cast(null as bigint))"))
    copies = F.filter(F.concat(copies, F.array("part")), lambda n: n > 0)
    rows = plan.where("taken > 0").withColumn("words_taken", F.explode(copies))
    whole = F.col("words_taken") == F.col("size")
    new = {"text": F.when(whole, F.col("mixed_row")["text"]).otherwise(first_words()), "n_chars": F.when(whole, F.col("mixed_row")["n_chars"]).otherwise(F.length(first_words())) if "n_chars" in names else None}
    return rows.select(*[(new[n] if n in new else F.col("mixed_row")[n]).alias(n) for n in names])


def first_words() -> Column:
    """The first words_taken words of text, joined by spaces."""
    return F.array_join(F.slice(words_of(F.col("mixed_row")["text"]), 1, F.col("words_taken").cast("int")), " ")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 1, 2, 3 mix of all sources takes of each document."""
    return plan_mix(documents(spark, sf_dir), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, '')))) AS k FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS r FROM src),
weighed AS (SELECT *, CAST((r - 1) % 3 + 1 AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM ranked),
levelled AS (
  SELECT *, cap / w AS ratio,
    (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lvl
  FROM weighed),
picked AS (SELECT arg_min(lvl, (ratio, r)) AS lvl FROM levelled WHERE lvl <= ratio),
budgets AS (
  SELECT l.source, source_size,
    coalesce(CASE WHEN ratio < p.lvl THEN cap ELSE least(w * p.lvl, cap) END, cap) AS target
  FROM levelled l, picked p),
cut AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, CAST(floor(b.target + 0.5) AS BIGINT) AS budget,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + least(greatest(budget % source_size - before, 0), size) END AS BIGINT) AS taken
FROM cut
"""
