"""What the operators of this subpackage share: shared folders, word expressions, null-safe keys."""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the controls 9-13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share (spark.checkpoint.dir).

    The setting is read from the session; only where it is unset, as in tests, a local one is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "/tmp/dirspark-checkpoints"
        spark.sparkContext.setCheckpointDir(root)
    return qualified(spark, f"{root.rstrip('/')}/dirspark-{uuid.uuid4().hex}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark resolves it to, so that code in executors opens it on the same file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


class Noting(threading.local):
    """The list that takes the folders of tables that this thread settles, if there is one."""

    folders: list[str] | None = None


noting = Noting()


@contextmanager
def noted(folders: list[str]) -> Iterator[None]:
    """The folders of tables that are settled inside are added to folders."""
    before, noting.folders = noting.folders, folders
    try:
        yield
    finally:
        noting.folders = before


def remove(spark: SparkSession, folder: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def settle(df: DataFrame, name: str = "part") -> DataFrame:
    """Write df below the shared folder and read it back.

    This cuts lineage: a lost executor costs a reread of files, never a recomputation, and a
    result that depends on row order inside a task is fixed once.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if noting.folders is not None:
        noting.folders.append(folder)
    path = os.path.join(folder, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words in order, as an array."""
    return F.filter(F.split(text, GAP), lambda w: w != F.lit(""))


def nullsafe(column: str) -> Column:
    """A string that tells null from every value, to join and group on."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))
