"""Phrase collocations by hashed counting passes.

Pass k counts phrases of k words exactly, but only those that can still be frequent: both of their parts of k - 1 words must
be (Apriori), and the bucket that they fall into must have reached the threshold when pass k - 1 counted
buckets of the next length (PCY; in later passes only phrases whose parts were candidates are put into buckets, as DHP does). Both tests
are bitmaps of a fixed size (BUCKETS bits), so broadcasting them doesn't grow with the data; what they let through in vain is
counted and falls at the threshold. Counts are exact: tasks tell phrases apart by their words, and sums are shuffled by phrase.

Bucket counts stop at the threshold inside a task (one byte each), which changes no decision, and are summed by ranges of buckets in a stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.common import documents, settle, text_of

#: Marks that end a piece, the letters to lower, and the name of documents without a language.
ENDS = b".,;:!?\n\x0b\x0c\r"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
UNKNOWN = "und"
LEAST, LONGEST, TOP = 100, 5, 2000
BUCKETS, RANGE = 1 << 24, 1 << 16
#: Words that a task counts at once, and words that it remembers.
BLOCK_WORDS, REMEMBERED = 1 << 20, 600_000
STEP = np.uint64(0x9E3779B97F4A7C15)
MARKED = bytes.maketrans(UPPER + ENDS, LOWER + b"." * len(ENDS))
ROWS = "lang string, phrase string, n long, range int, places binary, counts binary"
NAMES = ["lang", "phrase", "n", "range", "places", "counts"]


def tokens(text: str) -> list[bytes]:
    """The words, with b'.' between pieces."""
    return text.encode().translate(MARKED).replace(b".", b" . ").split()


def scattered(x: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


def seed_of(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 1))


def hash_of(lang: str, phrase: str) -> np.uint64:
    """The same as rolled() gives for the phrase's place."""
    h = seed_of(lang)
    with np.errstate(over="ignore"):
        for w in phrase.encode().split(b" "):
            h = h * STEP + np.uint64(xxhash.xxh64_intdigest(w))
    return h


def rolled(words: np.ndarray, seed: np.uint64, length: int) -> np.ndarray:
    """The hash of the length words from each place on."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, seed, dtype=np.uint64)
    for k in range(length):
        out = out * STEP + words[k : k + n]
    return out


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = scattered(hashes, 8 * len(bitmap))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


class Counter:
    """What a task holds: words by number, texts to count by language, and the buckets of the next length."""

    def __init__(self, length: int, parts: np.ndarray | None, reached: np.ndarray | None, least: int, longest: int, buckets: int, remembered: int):
        self.length, self.parts, self.reached, self.remembered = length, parts, reached, remembered
        self.most = min(least, 255)
        self.next = np.zeros(buckets, dtype=np.uint8) if length < longest else None
        self.held: dict[str, list[int]] = {}
        self.size = 0
        self.forget()

    def forget(self) -> None:
        self.number = {b".": 0}
        self.words, self.hashes = [b"."], [0]

    def add(self, lang: str, text: str) -> None:
        number, held = self.number, self.held.setdefault(lang, [])
        found = tokens(text)
        for w in set(found).difference(number):
            number[w] = len(self.words)
            self.words.append(w)
            self.hashes.append(xxhash.xxh64_intdigest(w))
        held += [number[w] for w in found]
        held.append(0)
        self.size += len(found) + 1

    def flush(self) -> Iterator[pa.RecordBatch]:
        hashes = np.array(self.hashes, dtype=np.uint64)
        for lang, ids in self.held.items():
            if (batch := self.count(lang, np.array(ids, dtype=np.int64), hashes)) is not None:
                yield batch
        self.held, self.size = {}, 0
        if len(self.words) > self.remembered:
            self.forget()

    def count(self, lang: str, ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch | None:
        n, words, seed = self.length, hashes[ids], seed_of(lang)
        inside = ids > 0
        whole = inside
        for k in range(1, n):
            whole = whole[: len(ids) - k] & inside[k:]
        own = rolled(words, seed, n)
        if n > 1:
            part = has(self.parts, rolled(words, seed, n - 1))
            whole = whole & part[:-1] & part[1:]
            at = np.flatnonzero(whole)
            whole[at] = has(self.reached, own[at])
        at = np.flatnonzero(whole)
        if self.next is not None:
            further = np.flatnonzero(whole[:-1] & whole[1:] & inside[n:]) if len(whole) > 1 else at[:0]
            places, many = np.unique(scattered(own[further] * STEP + words[further + n], len(self.next)), return_counts=True)
            self.next[places] = np.minimum(self.next[places] + many, self.most)
        if not len(at):
            return None
        first, many = distinct(ids, at, own[at], n)
        columns = [[self.words[i] for i in ids[first + k].tolist()] for k in range(n)]
        phrases = columns[0] if n == 1 else [b" ".join(x) for x in zip(*columns, strict=True)]
        size = len(first)
        return pa.record_batch([pa.array([lang] * size, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(many, pa.int64()), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary())], NAMES)

    def filled(self) -> Iterator[pa.RecordBatch]:
        """The buckets that are not empty, by ranges."""
        if self.next is not None:
            yield from ranges(np.flatnonzero(self.next), self.next)


def ranges(places: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    of = places // RANGE
    edges = [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(places)]
    for p, q in zip(edges[:-1], edges[1:], strict=True):
        inner = (places[p:q] % RANGE).astype("<u2").tobytes()
        yield pa.record_batch([pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([of[p]], pa.int32()), pa.array([inner], pa.binary()), pa.array([counts[places[p:q]].astype(np.uint8).tobytes()], pa.binary())], NAMES)


def distinct(ids: np.ndarray, at: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first place and the count of each distinct phrase among places at. Hashes sort them, words tell them apart."""
    order = np.argsort(hashes, kind="stable")
    sorted_at, sorted_hashes = at[order], hashes[order]
    new = np.concatenate([[True], sorted_hashes[1:] != sorted_hashes[:-1]])
    leader = sorted_at[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    if any((ids[leader + k] != ids[sorted_at + k]).any() for k in range(n)):  # two phrases with one hash
        sorted_at = at[np.lexsort([ids[at + k] for k in range(n)])]
        new = np.zeros(len(at), dtype=bool)
        new[0] = True
        for k in range(n):
            new[1:] |= ids[sorted_at[1:] + k] != ids[sorted_at[:-1] + k]
    starts = np.flatnonzero(new)
    return sorted_at[starts], np.diff(np.append(starts, len(at)))


def reached(rows: DataFrame, least: int, buckets: int) -> np.ndarray:
    """The bitmap of buckets whose counts sum up to least, from rows of ranges; buckets / 8 bytes at the driver, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, places, counts in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if r not in sums:
                    sums[r] = np.zeros(RANGE, dtype=np.uint32)
                x = np.frombuffer(places, dtype="<u2")
                sums[r][x] = np.minimum(sums[r][x] + np.frombuffer(counts, dtype=np.uint8), 1 << 24)
        for r, x in sums.items():
            yield pa.record_batch([pa.array([r], pa.int32()), pa.array([np.packbits(x >= least, bitorder="little").tobytes()], pa.binary())], ["range", "bits"])

    rows = rows.where(F.col("range").isNotNull()).select("range", "places", "counts").repartition(F.col("range"))
    out = np.zeros(buckets // 8, dtype=np.uint8)
    for r in rows.mapInArrow(run, "range int, bits binary").collect():
        out[r["range"] * (RANGE // 8) : (r["range"] + 1) * (RANGE // 8)] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def bitmap_of(frequent: DataFrame, buckets: int) -> np.ndarray:
    """The bitmap of the buckets that frequent phrases fall into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, dtype=np.uint8)
        for batch in batches:
            if batch.num_rows:
                seen[scattered(np.array([hash_of(a, b) for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], dtype=np.uint64), buckets)] = 1
        yield from ranges(np.flatnonzero(seen), seen)

    return reached(frequent.select("lang", "phrase").mapInArrow(run, ROWS), 1, buckets)


def counted(texts: DataFrame, length: int, parts: np.ndarray | None, bits: np.ndarray | None, least: int, longest: int, buckets: int) -> DataFrame:
    """One pass over texts (lang, text): partial counts of phrases, and ranges of the next length's buckets."""
    held, block, remembered = texts.sparkSession.sparkContext.broadcast((parts, bits)), BLOCK_WORDS, REMEMBERED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(length, *held.value, least, longest, buckets, remembered)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counter.add(lang, text.as_py())
                if counter.size >= block:
                    yield from counter.flush()
        yield from counter.flush()
        yield from counter.filled()

    return texts.mapInArrow(run, ROWS)


def frequencies(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, n) of all phrases of k words with n >= least, and (lang, n) of all words. Both settled."""
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), text_of().alias("text"))
    parts = bits = totals = None
    found: list[DataFrame] = []
    for length in range(1, longest + 1):
        rows = settle(counted(texts, length, parts, bits, least, longest, buckets))
        sums = rows.where(F.col("range").isNull()).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        if length == 1:
            sums = settle(sums)
            totals = settle(sums.groupBy("lang").agg(F.sum("n").alias("n")))
        found.append(settle(sums.where(F.col("n") >= least).withColumn("k", F.lit(length))))
        if length == longest or found[-1].isEmpty():
            break
        parts, bits = bitmap_of(found[-1], buckets), reached(rows, least, buckets)
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, buckets: int = BUCKETS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first top phrases of each language.

    Null texts are empty; documents without a language count as one language, UNKNOWN. Every row counts, repeated ones too. Other columns aren't read, so names don't clash.
    An empty table, and one without a frequent phrase, gives no rows. Ties in score and count are ordered by the phrase's bytes.
    """
    known, totals = frequencies(docs, least, longest, buckets)
    many = known.where("k > 1").select("lang", "phrase", F.col("n").alias("a"), "k", F.split("phrase", " ").alias("words"))
    inner = (
        many.where("k > 2").select("lang", "a", "words", "k", F.explode(F.expr("sequence(2, k - 1)")).alias("size"))
        .select("lang", "a", F.explode(F.expr("transform(sequence(1, k - size + 1), i -> array_join(slice(words, i, size), ' '))")).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    left = many.join(inner, ["lang", "phrase"], "left").where("longer is null or longer < a")
    cuts = left.select("lang", "phrase", "a", F.explode(F.expr("transform(sequence(1, k - 1), i -> struct(i as cut, array_join(slice(words, 1, i), ' ') as first, array_join(slice(words, i + 1, k - i), ' ') as rest))")).alias("x")).select("lang", "phrase", "a", "x.*")
    sizes = known.select("lang", "phrase", "n")
    cuts = cuts.join(sizes.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]).join(sizes.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(totals, "lang")
    # 38 digits hold these products for counts below 10^16
    score = F.expr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(16, 0)) * cast(n as decimal(16, 0))) div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
grams AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase FROM worded, range(1, 6) AS t(k) WHERE len(ws) >= k),
f AS (SELECT lang, phrase, k, count(*) AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, k, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 100),
inner_ AS (
  SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM cand, range(2, 5) AS u(s), range(1, 5) AS v(i) WHERE s < k AND i + s - 1 <= k GROUP BY ALL),
kept AS (SELECT c.* FROM cand c LEFT JOIN inner_ i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 100 * c.a),
cut AS (
  SELECT c.lang, c.phrase, c.a, j, l.n AS l, r.n AS r, t.n AS n, (1000::HUGEINT * c.a * t.n) // (l.n::HUGEINT * r.n) AS score
  FROM kept c JOIN range(1, 5) AS w(j) ON j < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[j + 1:], ' ')
  JOIN total t ON t.lang = c.lang),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""
