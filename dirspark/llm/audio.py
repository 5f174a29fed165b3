"""Media columns: chroma audio fingerprints.

Samples become frames of energy in twelve pitch classes. An integral image over frames and classes makes the sum of any rectangle
four lookups; sixteen filters compare rectangles, and each difference, quantised to two bits in Gray code, is a part of a frame's
packed 32-bit integer. Recordings are aligned through equal integers: an inverted list of integers pairs frames, the differences of
their places form a histogram for each pair of recordings, and the best offset is confirmed by the share of differing bits.

Recordings with equal fingerprints are one class, and only classes are paired. Queries and classes are dealt out as pairs of blocks.
A task has both blocks whole and counts every equal integer, however common, so a common integer is spread over all
tasks and its pairs of frames are never rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.common import settle, table

RATE, FRAME, HOP = 8000, 1024, 512
CLASSES = 12
#: Filters: kind (which halves or thirds are compared), first class, classes, frames.
FILTERS = [(kind, first, height, width) for kind, width in ((0, 4), (1, 6), (2, 6), (3, 3)) for first, height in ((0, 4), (4, 4), (8, 4), (0, 12))]
LONGEST = max(f[3] for f in FILTERS)
#: Edges between the four levels of a filter's response, the logarithm of the ratio of two areas; none at 0, where steady tones lie.
LEVELS = (-0.4, 0.05, 0.4)
GRAY = (0, 1, 3, 2)
MOST_ERRORS = 0.25
#: Fewer frames would align by chance: 8 have 256 bits, of which 64 may differ.
LEAST_FRAMES = 8
#: Frames in a block of queries or classes, about, and pairs of equal frames that are counted at once.
BLOCK_FRAMES, STEP_HITS = 1 << 21, 1 << 20


@lru_cache(maxsize=2)
def pitch_classes(rate: int) -> np.ndarray:
    """The pitch class of each bin of a frame's spectrum; -1 outside 28 Hz to 3520 Hz."""
    hz = np.arange(FRAME // 2 + 1) * rate / FRAME
    out = np.full(len(hz), -1)
    ok = (hz >= 28) & (hz <= 3520)
    out[ok] = np.round(12 * np.log2(hz[ok] / 440.0)).astype(int) % 12
    return out


def chroma(samples: np.ndarray, rate: int = RATE) -> np.ndarray:
    """Frames by pitch classes, each frame's energies summing to one (silence: even)."""
    if len(samples) < FRAME:
        return np.zeros((0, CLASSES))
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP]
    power = np.abs(np.fft.rfft(frames * np.hanning(FRAME), axis=1)) ** 2
    of = pitch_classes(rate)
    out = np.stack([power[:, of == k].sum(axis=1) for k in range(CLASSES)], axis=1) + 1e-9
    return out / out.sum(axis=1, keepdims=True)


def fingerprint(image: np.ndarray) -> np.ndarray:
    """Packed integers of the frames that all filters reach."""
    n = len(image) - LONGEST + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    sums = np.zeros((len(image) + 1, CLASSES + 1))
    sums[1:, 1:] = image.cumsum(axis=0).cumsum(axis=1)
    at = np.arange(n)

    def area(t: int, c: int, w: int, h: int) -> np.ndarray:
        return sums[at + t + w, c + h] - sums[at + t, c + h] - sums[at + t + w, c] + sums[at + t, c] + 1e-6

    out = np.zeros(n, dtype=np.uint32)
    for kind, c, h, w in FILTERS:
        if kind == 0:  # later against earlier
            a, b = area(w // 2, c, w // 2, h), area(0, c, w // 2, h)
        elif kind == 1:  # upper against lower classes
            a, b = area(0, c + h // 2, w, h // 2), area(0, c, w, h // 2)
        elif kind == 2:  # middle third in time against both others
            a, b = area(w // 3, c, w // 3, h), (area(0, c, w // 3, h) + area(2 * (w // 3), c, w // 3, h)) / 2
        else:  # diagonal quarters
            a = area(0, c, w // 2, h // 2) + area(w // 2, c + h // 2, w - w // 2, h - h // 2)
            b = area(w // 2, c, w - w // 2, h // 2) + area(0, c + h // 2, w // 2, h - h // 2)
        level = np.digitize(np.log(a / b), LEVELS)
        out = out << np.uint32(2) | np.array(GRAY, dtype=np.uint32)[level]
    return out


def prints_of(recordings: DataFrame, rate: int = RATE) -> DataFrame:
    """rec_id, n_frames and prints (packed little-endian) of recordings (rec_id, samples: array of floats). Null samples and values count as silence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for x in batch.column(1):
                values = np.zeros(0) if not x.is_valid else np.nan_to_num(np.array(x.values.fill_null(0.0), dtype=np.float64))
                got.append(fingerprint(chroma(values, rate)))
            yield pa.record_batch([batch.column(0), pa.array([len(g) for g in got], pa.int64()), pa.array([g.astype("<u4").tobytes() for g in got], pa.binary())], ["rec_id", "n_frames", "prints"])

    return recordings.select("rec_id", "samples").mapInArrow(run, "rec_id long, n_frames long, prints binary")


def steps(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of items whose sizes add up to at most most; a larger item is a run of its own."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items of so many parts: the item of each part, and the part's place in it."""
    item = np.repeat(np.arange(len(counts)), counts)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)


class Prints:
    """The fingerprints of a block's recordings, one after another."""

    def __init__(self, ids: list[int], raw: list[bytes]) -> None:
        self.ids = np.array(ids, dtype=np.int64)
        self.sizes = np.array([len(x) // 4 for x in raw], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.values = np.frombuffer(b"".join(raw), dtype="<u4")
        self.owner, self.place = spread(self.sizes)


def best_offsets(q: Prints, k: Prints) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, class (as numbers in their blocks) and the most frequent offset (ties: the smallest) of all pairs that share an integer."""
    order = np.argsort(k.values, kind="stable")
    ranked = k.values[order]
    low = np.searchsorted(ranked, q.values, "left")
    hits = np.searchsorted(ranked, q.values, "right") - low
    longest = int(q.sizes.max())
    span = longest + int(k.sizes.max())
    of_query = np.add.reduceat(hits, q.starts)
    for a, b in steps(of_query, STEP_HITS):
        first, end = q.starts[a], q.starts[b - 1] + q.sizes[b - 1]
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for c, d in steps(hits[first:end], STEP_HITS):
            frame, nth = spread(hits[first + c : first + d])
            frame += first + c
            at = order[low[frame] + nth]
            other = q.ids[q.owner[frame]] != k.ids[k.owner[at]]
            frame, at = frame[other], at[other]
            found, n = np.unique((q.owner[frame] * len(k.ids) + k.owner[at]) * span + (k.place[at] - q.place[frame] + longest), return_counts=True)
            codes, inverse = np.unique(np.concatenate([codes, found]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([counts, n]), len(codes)).astype(np.int64)
        pair, offset = codes // span, codes % span - longest
        rank = np.lexsort((offset, -counts, pair))
        pair, offset = pair[rank], offset[rank]
        top = np.flatnonzero(np.diff(pair, prepend=-1))
        yield pair[top] // len(k.ids), pair[top] % len(k.ids), offset[top]


def confirmed(q: Prints, k: Prints) -> Iterator[pa.RecordBatch]:
    """The rows of align() for a block of queries and a block of classes."""
    for x, y, offset in best_offsets(q, k):
        start = np.maximum(0, -offset)
        n = np.minimum(q.sizes[x], k.sizes[y] - offset) - start
        enough = n >= LEAST_FRAMES
        x, y, offset, start, n = (v[enough] for v in (x, y, offset, start, n))
        for a, b in steps(n, STEP_HITS):
            pair, nth = spread(n[a:b])
            own = (q.starts[x] + start)[a:b][pair] + nth
            theirs = (k.starts[y] + start + offset)[a:b][pair] + nth
            errors = np.bincount(pair, np.bitwise_count(q.values[own] ^ k.values[theirs]), b - a).astype(np.int64)
            ok = np.flatnonzero(errors <= MOST_ERRORS * 32 * n[a:b])
            yield pa.record_batch([pa.array(q.ids[x[a + ok]]), pa.array(k.ids[y[a + ok]]), pa.array(offset[a + ok].astype(np.int32)), pa.array(n[a + ok]), pa.array(errors[ok])], ["query_class", "class_id", "offset", "n_frames", "bit_errors"])


def align(queries: DataFrame, classes: DataFrame) -> DataFrame:
    """query_class, class_id, offset, n_frames and bit_errors of pairs of classes that align. Rows: class_id, prints (not empty).

    The offset is the histogram's most frequent one (ties: the smallest); frames that overlap at it are compared.
    """
    frames = F.coalesce(F.sum(F.length("prints")), F.lit(0)) / 4
    blocks = lambda df: -(-int(df.agg(frames).first()[0]) // BLOCK_FRAMES)
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    of_queries = max(1, blocks(queries))
    of_classes = max(1, blocks(classes), -(-n // of_queries))

    def dealt(df: DataFrame, own: str, many: int, other: str, others: int, is_query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("class_id"), F.lit(many)).cast("int")
        rows = df.select("class_id", "prints", block.alias(own), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))
        return rows.select("q_block", "k_block", F.lit(is_query).alias("is_query"), "class_id", "prints")

    rows = dealt(queries, "q_block", of_queries, "k_block", of_classes, True).unionByName(dealt(classes, "k_block", of_classes, "q_block", of_queries, False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, (([], []), ([], []))

        def pairs() -> Iterator[pa.RecordBatch]:
            return confirmed(Prints(*held[1]), Prints(*held[0])) if held[0][0] and held[1][0] else iter(())

        for batch in batches:
            for q_block, k_block, is_query, class_id, prints in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (q_block, k_block) != key:
                    yield from pairs()
                    key, held = (q_block, k_block), (([], []), ([], []))
                held[is_query][0].append(class_id)
                held[is_query][1].append(prints)
        yield from pairs()

    order = ["q_block", "k_block"]
    return rows.repartition(n, *order).sortWithinPartitions(*order).mapInArrow(run, "query_class long, class_id long, offset int, n_frames long, bit_errors long")


def match_recordings(recordings: DataFrame, is_query: str) -> DataFrame:
    """One row for each recording: its class (the smallest rec_id with the same fingerprint), whether it is a query, and, for its class, the best aligned class of a query.

    Best: fewest bit errors for a frame, then most frames, then the smallest class. Recordings too short for a frame have class null and match nothing.
    Rows with equal or null ids stay rows; a class is named by its smallest id that isn't null.
    """
    prints = settle(prints_of(recordings), "prints")
    named = prints.where("n_frames > 0 AND rec_id IS NOT NULL").groupBy("prints").agg(F.min("rec_id").alias("class_id"))
    named = settle(named, "classes")
    queries = settle(prints.where(f"rec_id IS NOT NULL AND ({is_query})").select("prints").distinct().join(named, "prints"), "queries")
    found = align(queries, named)
    rate = F.col("bit_errors") / (32.0 * F.col("n_frames"))
    best = found.groupBy("class_id").agg(F.min(F.struct(rate.alias("rate"), (-F.col("n_frames")).alias("less"), "query_class", "offset", "bit_errors", "n_frames")).alias("m"), F.count(F.lit(1)).alias("n_matches"))
    out = prints.join(named, "prints", "left").join(best, "class_id", "left")
    return out.select("rec_id", "n_frames", "class_id", F.expr(f"coalesce({is_query}, false)").alias("is_query"), F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.col("m.query_class").alias("best_query"), F.col("m.offset").alias("best_offset"), F.col("m.bit_errors").alias("bit_errors"), F.crc32("prints").alias("prints_crc32"))


def vector_recordings(vectors: DataFrame) -> DataFrame:
    """A recording of each vector (vec_id, embedding): the tune of its hundred (ids that agree but for the last two digits), behind
    an intro of its own and with its own hiss.

    The driver's tables hold no audio; this makes real samples with a known truth: recordings of one hundred align, at an
    offset of twice the difference of their ids modulo 5. Null and empty vectors are silent recordings without samples, null ids have a tune of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, sounds = batch.slice(at, 64), []
                for i, x in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    v = np.zeros(0) if not x.is_valid else np.nan_to_num(np.array(x.values.fill_null(0.0), dtype=np.float64))
                    sounds.append(take(-1 if i is None else i, v))
                yield pa.record_batch([part.column(0).cast(pa.int64()), pa.array(sounds, pa.list_(pa.float32()))], ["rec_id", "samples"])

    return vectors.select("vec_id", "embedding").mapInArrow(run, "rec_id long, samples array<float>")


def notes(steps: np.ndarray, samples: int, rate: int = RATE) -> np.ndarray:
    """Chords of tones (rows of semitones above 220 Hz), each so many samples long."""
    t = np.arange(samples) / rate
    return np.sin(2 * np.pi * 220.0 * 2 ** (steps[:, :, None] / 12) * t).sum(axis=1).reshape(-1)


@lru_cache(maxsize=64)
def tune(hundred: int, length: int = 16) -> np.ndarray:
    return notes(np.random.default_rng(hundred % (1 << 63)).integers(0, 24, (length, 3)), RATE // 8)


def take(ident: int, v: np.ndarray) -> np.ndarray:
    """The intro's notes follow the signs of all values of the vector, and its values, stretched over the whole, are the hiss."""
    if not len(v):
        return np.zeros(0, dtype=np.float32)
    beats = ident % 5
    steps = np.array([[np.abs(part).argmax() % 12, (part > 0).sum() % 24] for part in np.array_split(np.resize(v, max(len(v), 5)), 5)])[:beats]
    whole = np.concatenate([notes(steps, 2 * HOP), tune(ident // 100)]) if beats else tune(ident // 100)
    hiss = np.interp(np.arange(len(whole)) * 0.37 % len(v), np.arange(len(v)), v)
    return (whole + 0.3 * hiss).astype(np.float32)


def op10_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's recording with its class and the best of the queries (ids divisible by 50) that align with it."""
    return match_recordings(vector_recordings(table(spark, sf_dir, "embeddings")), "rec_id % 50 = 0")
