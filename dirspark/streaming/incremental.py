"""Incremental work: new files only, new rows only, due jobs, and throughput."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def new_files(spark: SparkSession, folder: str, schema: str, form: str = "json") -> DataFrame:
    """A stream of the rows of files not seen before; the checkpoint remembers them."""
    return spark.readStream.schema(schema).format(form).load(folder)


def run_new(rows: DataFrame, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Apply step to each batch of new rows and write it once: a batch that is repeated overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def due_jobs(jobs: DataFrame, as_of: str, limit: int) -> DataFrame:
    """The next jobs to run: queued, due and not out of attempts, by priority."""
    now = F.lit(as_of).cast("timestamp")
    ready = jobs.where((F.col("status") == "queued") & (F.col("run_after") <= now) & (F.col("attempts") < F.col("max_attempts")))
    return ready.orderBy(F.col("priority").desc(), "run_after", "job_id").limit(limit)


def after_failure(jobs: DataFrame, as_of: str, wait_s: int = 30) -> DataFrame:
    """A failed job waits longer each time, and fails for good at its last attempt."""
    tries = F.col("attempts") + 1
    later = F.timestamp_seconds(F.unix_timestamp(F.lit(as_of).cast("timestamp")) + wait_s * tries)
    return jobs.withColumns({"attempts": tries, "status": F.when(tries >= F.col("max_attempts"), "failed").otherwise("queued"), "run_after": F.when(tries < F.col("max_attempts"), later)})


def throughput(polls: DataFrame, seconds: float = 4.0) -> DataFrame:
    """Rows for each second between polls (polled_at, n)."""
    return polls.withColumn("rate", (F.col("n") - F.lag("n").over(Window.partitionBy("source").orderBy("polled_at"))) / seconds)


def windowed(events: DataFrame, size: str = "1 day", late: str = "2 days") -> DataFrame:
    """Extra: counts and sums by event type in windows of event time; runs on tables and on streams."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
