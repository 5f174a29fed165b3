"""Token counts as delta-maintained rollups.

The state is a folder of totals by source, language and tokenizer version. A batch of changes (inserted documents
with +1, deleted ones with -1, revised counts as the old value with -1 and the new with +1) is summed by group first; only
those sums, a few for each source, meet the totals. A commit is a small file named by its number that tells the batch's id and
the folder of the totals after it; it gets its name by a rename that fails where the name is taken, so of two writers one
commits and the other starts again from the new totals. A batch that was committed before is found by its id and changes
nothing. Totals of a group that reach zero documents stay as zeros.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.bpe import tokenizer_path
from dirspark.llm.common import documents, qualified, settle, shared_dir, table, text_of, word_count
from dirspark.llm.tokenfiles import token_counts

GROUP = ["source", "lang", "tokenizer"]
TOTALS = ["n_docs", "n_tokens"]
STATE = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMMIT = "seq long, batch_id string, state string"


class Rollup:
    """Totals below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, qualified(spark, folder)
        self.log = f"{self.folder}/commits"

    def committed(self) -> DataFrame:
        """seq, batch_id and state (a folder) of each commit."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.log)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], COMMIT)
        return self.spark.read.schema(COMMIT).json(self.log)

    def last(self) -> tuple[int, DataFrame]:
        """The number of the last commit (0: none) and the totals after it."""
        found = self.committed().agg(F.max(F.struct("seq", "state")).alias("x")).first().x
        if found is None:
            return 0, self.spark.createDataFrame([], STATE)
        return found.seq, self.spark.read.schema(STATE).parquet(f"{self.folder}/{found.state}")

    def totals(self) -> DataFrame:
        return self.last()[1]

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit changes(source, lang, tokenizer, sign, n_tokens) once. False if the batch was committed before.

        Null signs and counts are 0. Totals are written first, into a folder of their own, and count only when a commit names them, so a run that
        dies before leaves nothing that is read.
        """
        sign, n = F.coalesce(F.col("sign").cast("long"), F.lit(0)), F.coalesce("n_tokens", F.lit(0))
        delta = changes.groupBy(*GROUP).agg(F.sum(sign).alias("n_docs"), F.sum(sign * n).alias("n_tokens"))
        while self.committed().where(F.col("batch_id") == batch_id).isEmpty():
            seq, totals = self.last()
            state = f"state-{seq + 1}-{uuid.uuid4().hex}"
            totals.unionByName(delta).groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in TOTALS]).write.parquet(f"{self.folder}/{state}")
            if self.claim(seq + 1, json.dumps({"seq": seq + 1, "batch_id": batch_id, "state": state})):
                return True
        return False

    def claim(self, seq: int, content: str) -> bool:
        """Whether the commit with this number is ours: content is written under a hidden name, and renamed unless the name is taken."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        files = path(self.log).getFileSystem(conf)
        hidden = path(f"{self.log}/.{uuid.uuid4().hex}")
        out = files.create(hidden)
        out.write(bytearray(content.encode()))
        out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(self.log).toUri(), conf).rename(hidden, path(f"{self.log}/{seq:012d}.json"), options)
        except (Py4JJavaError, PySparkException) as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            files.delete(hidden, False)
            return False
        return True

    def follow(self, changes: DataFrame, name: str, checkpoint: str):
        """Commit the micro-batches of a stream of changes, each under its number: one that comes again changes nothing."""
        return changes.writeStream.foreachBatch(lambda batch, n: self.apply(f"{name}-{n}", batch) and None).option("checkpointLocation", checkpoint).start()


def inserted(docs: DataFrame, tokenizer: str, count: Column) -> DataFrame:
    """Null sources and languages are groups of their own; null texts count 0 tokens."""
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(1).alias("sign"), count.alias("n_tokens"))


def deleted(docs: DataFrame, tokenizer: str, count: Column) -> DataFrame:
    return inserted(docs, tokenizer, count).withColumn("sign", F.lit(-1))


def revised(docs: DataFrame, tokenizer: str, old: Column, new: Column) -> DataFrame:
    """The old count leaves and the new one comes; the number of documents stays."""
    return deleted(docs, tokenizer, old).unionByName(inserted(docs, tokenizer, new))


def word_tokens() -> Column:
    return word_count(text_of())


def byte_tokens() -> Column:
    return F.octet_length(text_of()).cast("long")


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, source, lang and the words, bytes and BPE tokens of each text. Texts are read once and go no further."""
    rows = docs.select("text", "doc_id", "source", "lang", word_tokens().alias("words"), byte_tokens().alias("bytes"))
    return token_counts(rows, path or tokenizer_path(), ["doc_id", "source", "lang", "words", "bytes"])


def versions() -> dict[str, Column]:
    """Tokenizer versions, and the column of counted() that each fills."""
    return {"words-1": F.col("words"), "bytes-1": F.col("bytes"), "byte_bpe_50k-1": F.col("n_tokens")}


def under_all(change, docs: DataFrame) -> DataFrame:
    """change (inserted or deleted) under each version."""
    first, *rest = [change(docs, name, count) for name, count in versions().items()]
    for x in rest:
        first = first.unionByName(x)
    return first


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents came under three tokenizers, toxic ones left, the BPE counts of those of low quality were revised (an end id
    each), and a batch came twice. Labels meet counts, never texts."""
    docs = settle(counted(documents(spark, sf_dir)), "counts")
    labels = table(spark, sf_dir, "labels")
    toxic = docs.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    low = docs.join(labels.where("quality = 0 AND toxic = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    rollup = Rollup(spark, f"{shared_dir(spark)}/counts")
    rollup.apply("all", under_all(inserted, docs))
    rollup.apply("toxic", under_all(deleted, toxic))
    rollup.apply("low", revised(low, "byte_bpe_50k-1", F.col("n_tokens"), F.col("n_tokens") + 1))
    rollup.apply("toxic", under_all(deleted, toxic))
    return rollup.totals()
