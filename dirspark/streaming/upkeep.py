"""Derived flags kept from batch to batch: counts by key are moved by what a batch adds and removes, and only rows whose key crosses a threshold are written again.

Below a folder lie two logs, rows and counts, with a folder for each batch, and commits. A row's or key's last committed entry holds. A
batch is committed last, so one that was cut off is not seen, and is overwritten when it is repeated; a committed one is not applied twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DerivedFlags:
    """Rows (ident and others) with a flag for each rule: whether at least so many rows have its key. Rows with a null or empty part of a key have none.

    rules: flag's name to (columns of the key, least number).
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, ident: str, rules: dict[str, tuple[list[str], int]]):
        self.spark, self.path, self.ident, self.rules = spark, path.rstrip("/"), ident, rules
        self.columns = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        self.names = [f.name for f in self.columns]
        flags = [T.StructField(f, T.BooleanType()) for f in rules]
        batch = T.StructField("batch", T.LongType())
        self.schemas = {
            "rows": T.StructType([*self.columns, *flags, T.StructField("deleted", T.BooleanType()), batch]),
            "counts": T.StructType([T.StructField("rule", T.StringType()), T.StructField("key", T.StringType()), T.StructField("n", T.LongType()), batch]),
            "commits": T.StructType([T.StructField("n_rows", T.LongType()), batch]),
        }

    def log(self, table: str, upto: int | None = None) -> DataFrame:
        """The committed entries of a table; with upto, those of that batch as well, committed or not."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}")
        if not root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root):
            return self.spark.createDataFrame([], self.schemas[table])
        found = self.spark.read.schema(self.schemas[table]).parquet(f"{self.path}/{table}")
        if table == "commits":
            return found
        done = self.committed() + ([upto] if upto is not None else [])
        return found.where(F.col("batch").isin(done))

    def committed(self) -> list[int]:
        """Numbers of batches: one for each since the log was last compacted."""
        return [r.batch for r in self.log("commits").select("batch").collect()]

    def latest(self, table: str, keys: list[str], upto: int | None = None) -> DataFrame:
        rows = self.log(table, upto)
        rest = [c for c in rows.columns if c not in (*keys, "batch")]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*")

    def current(self) -> DataFrame:
        """All rows with their flags."""
        return self.latest("rows", [self.ident]).where("NOT deleted").select(*self.names, *self.rules)

    def keyed(self, rows: DataFrame) -> DataFrame:
        """rows once for each rule that they have a key for, with rule and key."""
        told = []
        for rule, (columns, _) in self.rules.items():
            whole = F.lit(True)
            for c in columns:
                whole = whole & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
            told.append(F.when(whole, F.struct(F.lit(rule).alias("rule"), F.to_json(F.struct(*columns)).alias("key"))))
        return rows.withColumn("_k", F.explode(F.array(*told))).where("_k IS NOT NULL").select("*", "_k.rule", "_k.key").drop("_k")

    def apply(self, batch: DataFrame, number: int) -> int:
        """Take in a batch of new and changed rows (one for each ident; deleted, if there is such a column, takes rows away). How many rows were written."""
        if number in self.committed():
            return self.log("commits").where(F.col("batch") == number).first().n_rows
        batch = batch.select(*self.names, F.coalesce("deleted", F.lit(False)).alias("deleted") if "deleted" in batch.columns else F.lit(False).alias("deleted"))
        before = self.latest("rows", [self.ident]).where("NOT deleted").select(*self.names)
        ids = batch.select(self.ident)
        old = self.keyed(before.join(ids, self.ident, "left_semi")).select("rule", "key", F.lit(-1).alias("n"))
        new = self.keyed(batch.where("NOT deleted")).select("rule", "key", F.lit(1).alias("n"))
        moved = old.unionByName(new).groupBy("rule", "key").agg(F.sum("n").cast("long").alias("moved")).where("moved <> 0")
        known = self.latest("counts", ["rule", "key"])
        totals = moved.join(known, ["rule", "key"], "left").select("rule", "key", (F.coalesce("n", F.lit(0)) + F.col("moved")).alias("n"))
        self.write(totals, "counts", number)
        least = F.create_map(*[F.lit(x) for rule, (_, n) in self.rules.items() for x in (rule, n)])[F.col("rule")]
        now = self.spark.read.schema(self.schemas["counts"]).parquet(f"{self.path}/counts").where(F.col("batch") == number).select("rule", "key", F.col("n").alias("now"))
        crossed = now.join(known, ["rule", "key"], "left").where((F.col("now") >= least) != (F.coalesce("n", F.lit(0)) >= least)).select("rule", "key")
        others = self.keyed(before.join(ids, self.ident, "left_anti")).join(crossed, ["rule", "key"], "left_semi").select(*self.names).dropDuplicates([self.ident])
        rows = batch.unionByName(others.withColumn("deleted", F.lit(False)))
        counts = self.latest("counts", ["rule", "key"], number)
        held = self.keyed(rows).select(self.ident, "rule", "key").join(counts, ["rule", "key"]).where(F.col("n") >= least).groupBy(self.ident).agg(F.collect_set("rule").alias("_on"))
        rows = rows.join(held, self.ident, "left")
        rows = rows.select(*self.names, *[F.coalesce(F.array_contains("_on", f), F.lit(False)).alias(f) for f in self.rules], "deleted")
        self.write(rows, "rows", number)
        written = self.spark.read.schema(self.schemas["rows"]).parquet(f"{self.path}/rows").where(F.col("batch") == number).count()
        self.write(self.spark.range(1).select(F.lit(written).cast("long").alias("n_rows")), "commits", number)
        return written

    def write(self, rows: DataFrame, table: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/batch={number}")

    def compacted(self, path: str) -> DerivedFlags:
        """The same state as one batch below another folder."""
        out = DerivedFlags(self.spark, path, T.StructType(self.columns), self.ident, self.rules)
        number = max(self.committed(), default=0)
        out.write(self.latest("counts", ["rule", "key"]).where("n <> 0"), "counts", number)
        out.write(self.current().withColumn("deleted", F.lit(False)), "rows", number)
        out.write(self.spark.range(1).select(F.lit(0).cast("long").alias("n_rows")), "commits", number)
        return out


def keep_flags(stream: DataFrame, flags: DerivedFlags, checkpoint: str, more: Callable[[DataFrame], DataFrame] = lambda d: d) -> None:
    """Apply the batches of a stream; a batch that the stream repeats after a crash is applied once."""
    run = lambda batch, number: flags.apply(more(batch), number) and None
    stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
