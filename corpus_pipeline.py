"""The corpus pipeline: STAGES in order, each written as Parquet and reread as the next one's docs.

All stages but the last return the columns of documents. Each takes (spark, docs, sf_dir) and works on all that its
predecessor kept. As a stage begins, the tables that its predecessor settled are removed: the predecessor's rows have been written by then.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm import bpe, mixing, neardup, quality, suffixes
from dirspark.llm.common import noted, remove, shared_dir

#: The BPE stage and the near-duplicate components have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


class Left(threading.local):
    """Folders that this thread's stages have settled and not yet removed."""

    folders: tuple[str, ...] = ()


left = Left()


def stage(f: Stage) -> Stage:
    """f, with what earlier stages of this thread settled removed first. Tables that docs itself still reads, as it does where the stage before wasn't written, stay."""

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        files = docs.inputFiles() if left.folders else []
        stay = [x for x in left.folders if any(f"/{x.rsplit('/', 1)[1]}/" in file for file in files)]
        for x in set(left.folders).difference(stay):
            remove(spark, x)
        try:
            with noted(stay):
                return f(spark, docs, sf_dir)
        finally:
            left.folders = tuple(stay)

    return run


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id. Rows with a null id stay unless a row with an id is in their group."""
    return neardup.keep_first(docs)


@stage
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes in strings that an earlier document has are cut out; documents of which nothing is left go."""
    return suffixes.without_repeats(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken, and taken again, until each source has its share of the words."""
    return mixing.mix(docs)


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document taken, and the text that they decode to."""
    return bpe.encode_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-duplicate removal", near_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("mixing to target weights", mix_sources),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents. Each stage's rows are written below the shared folder, so a lost executor costs no earlier stage."""
    folder = shared_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        step(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
    return docs.select(*[F.col(c) for c in docs.columns])
