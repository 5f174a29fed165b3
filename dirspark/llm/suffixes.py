"""Suffix-array dedup: bytes in strings of WIDTH that an earlier document also has.

The work is dealt out by content. In every window of WIDTH bytes the smallest hash of its GRAM-byte strings
is the window's anchor, so equal windows have equal anchors wherever they stand. A first pass finds the anchors that
different texts share (equal texts count as one). A second pass cuts, from the first document of each text, the
stretches whose windows have such an anchor, and sends them to the anchor's part. There, anchors with a
single stretch are plain; the others' stretches form shards, whose Burrows-Wheeler transforms are
merged by interleave refinement (see bwt.py): common prefixes of WIDTH or more bound the repeated
intervals, and each window learns the smallest doc_id of its interval. The shares that are to go
come back by document.

Parts are sized by bytes and processed in chunks of bounded size at anchors' borders. Equal texts are those with equal 128 bits
of hash, equal strings those with equal bytes. Only numbers, the shared stretches and, twice, the texts are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.bwt import Shard, repeated_intervals
from dirspark.llm.common import WORD, documents, settle, text_of
from dirspark.llm.shingles import BYTE_VALUES, mixed, powers

WIDTH = 50
GRAM = 20
#: Bytes of text worked on at once, bytes that a task gathers before it sends them on, bytes merged at once and in one shard.
STEP_BYTES, SEND_BYTES, MERGE_BYTES, SHARD_BYTES = 1 << 20, 24 << 20, 2 << 20, 1 << 18
#: Bytes of text for each part, about: a task holds one part's share at a time.
PART_BYTES = 64 << 20
EMPTY = hashlib.sha256(b"").hexdigest()
LARGEST = np.iinfo(np.int64).max


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and text_id, 128 bits that stand for it."""
    return docs.select("doc_id", text_of().alias("text")).withColumn("text_id", id_of(F.col("text")))


def id_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one anchor: anchor, text's number, start in the text, number of windows; and all bytes' array."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    n = len(data) - WIDTH + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none, data
    power, inverse = powers(max(16, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * power[: len(data)], dtype=np.uint64)])
    least = mixed((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    span, have = WIDTH - GRAM + 1, 1
    while have < span:
        step = min(have, span - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    room = np.zeros(len(data) + 1, dtype=np.int8)
    long_enough = sizes >= WIDTH
    np.add.at(room, first[:-1][long_enough], 1)
    np.add.at(room, (first[1:] - WIDTH + 1)[long_enough], -1)
    inside = np.cumsum(room[:n]) > 0
    new = np.ones(n, dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
    new[first[:-1][long_enough]] = True
    at = np.flatnonzero(new & inside)
    ends = np.flatnonzero(np.concatenate([new[1:] | ~inside[1:], [True]]) & inside) + 1
    of = np.searchsorted(first, at, side="right") - 1
    return least[at], of, at - first[of], ends - at, data


def in_steps(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    a, size = 0, 0
    for b, t in enumerate(texts, 1):
        size += len(t)
        if size >= STEP_BYTES or b == len(texts):
            yield a, b, texts[a:b]
            a, size = b, 0


def compound(anchors: np.ndarray, n_parts: int) -> np.ndarray:
    """Part in the low, hash in the high 32 bits: what is sent of an anchor. That different anchors may share it costs work only."""
    return anchors >> np.uint64(32) << np.uint64(32) | anchors % np.uint64(n_parts)


def anchors_by_part(docs: DataFrame, n_parts: int) -> DataFrame:
    """part, and for each anchor in it of the texts of a task: 32 bits of the anchor, and 64 bits of the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, met = [], 0, set()

        def send() -> pa.RecordBatch:
            keys, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            part = (keys & np.uint64(0xFFFFFFFF)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            part, high, ids = part[order], (keys[order] >> np.uint64(32)).astype("<u4"), ids[order]
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, dtype=np.int64)
            ends = [*at[1:].tolist(), len(part)]
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(at.tolist(), ends, strict=False)], pa.binary())
            return pa.record_batch([pa.array(part[at]), cut(high), cut(ids)], ["part", "high", "texts"])

        for batch in batches:
            for a, b, texts in in_steps(batch, 0):
                ids = batch.column(1).slice(a, b - a).to_pylist()
                texts = {i: t for i, t in zip(ids, texts, strict=True) if len(t) >= WIDTH and i not in met}
                met.update(texts)
                ids = np.array(list(texts), dtype=np.int64)
                anchors, of, *_ = stretches(list(texts.values()))
                held.append((compound(anchors, n_parts), ids[of]))
                size += sum(map(len, texts.values()))
                if size >= SEND_BYTES:
                    yield send()
                    held, size, met = [], 0, set()
        if held:
            yield send()

    return docs.select(text_of().alias("text"), F.xxhash64(text_of()).alias("text_hash")).mapInArrow(run, "part int, high binary, texts binary")


def shared_anchors(parts: DataFrame) -> DataFrame:
    """text_hash and the compound anchors (packed) that another text has, too: a row for each text and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, high, texts = None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            h, t = np.concatenate(high), np.concatenate(texts)
            order = np.argsort(h, kind="stable")
            h, t = h[order], t[order]
            at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            shared = np.minimum.reduceat(t, at) != np.maximum.reduceat(t, at)
            keep = np.repeat(shared, np.diff([*at, len(h)]))
            h, t = h[keep], t[keep]
            order = np.argsort(t, kind="stable")
            h, t = h[order].astype(np.uint64) << np.uint64(32) | np.uint64(part), t[order]
            at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, dtype=np.int64)
            ends = [*at[1:].tolist(), len(t)]
            for k in range(0, len(at), 4096):
                rows = zip(at[k : k + 4096].tolist(), ends[k : k + 4096], strict=True)
                yield pa.record_batch([pa.array(t[at[k : k + 4096]]), pa.array([h[a:b].tobytes() for a, b in rows], pa.binary())], ["text_hash", "anchors"])

        for batch in batches:
            for p, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part and part is not None:
                    yield from found()
                    high, texts = [], []
                part = p
                high.append(np.frombuffer(x, dtype="<u4"))
                texts.append(np.frombuffer(y, dtype=np.int64))
        if high:
            yield from found()

    return parts.mapInArrow(run, "text_hash long, anchors binary")


def cut_stretches(wanted: DataFrame, n_parts: int) -> DataFrame:
    """From (doc_id, text, anchors of each part, text_hash): the stretches with these anchors, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            key, doc, start, length, text = (np.concatenate([x[i] for x in held]) for i in range(5))
            data = np.concatenate([x[5] for x in held])
            part = (key % np.uint64(n_parts)).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(length)])
            order = np.argsort(part, kind="stable")
            at = np.flatnonzero(np.concatenate([[True], part[order][1:] != part[order][:-1]])) if len(part) else []
            for a, b in zip(at, [*at[1:], len(part)], strict=False):
                o = order[a:b]
                packed = [key[o].tobytes(), doc[o].tobytes(), text[o].tobytes(), start[o].astype("<u4").tobytes(), length[o].astype("<u4").tobytes(), b"".join([data[i:j].tobytes() for i, j in zip(first[o].tolist(), first[o + 1].tolist(), strict=True)])]
                yield pa.record_batch([pa.array([part[o[0]]], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["part", "key", "doc", "text", "start", "length", "bytes"])

        for batch in batches:
            for a, b, texts in in_steps(batch, 1):
                docs, hashes = (np.asarray(batch.column(k).slice(a, b - a)) for k in (0, 3))
                mine = [np.frombuffer(b"".join(x), dtype=np.uint64) for x in batch.column(2).slice(a, b - a).to_pylist()]
                anchors, of, start, count, data = stretches(texts)
                sent, keep = compound(anchors, n_parts), np.zeros(len(anchors), dtype=bool)
                ends = np.searchsorted(of, np.arange(len(texts) + 1))
                for i, m in enumerate(mine):
                    keep[ends[i] : ends[i + 1]] = np.isin(sent[ends[i] : ends[i + 1]], m)
                first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                begin, length = (first[of] + start)[keep], (count + WIDTH - 1)[keep]
                if not len(begin):
                    continue
                take = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
                held.append((anchors[keep], docs[of[keep]].astype(np.int64), start[keep], length, hashes[of[keep]].astype(np.int64), data[take]))
                size += int(length.sum())
                if size >= SEND_BYTES:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()

    return wanted.mapInArrow(run, "part int, key binary, doc binary, text binary, start binary, length binary, bytes binary")


def window_minima(data: np.ndarray, length: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each byte of the strings: the smallest doc of all strings with the window that starts there; LARGEST where none does."""
    first = np.concatenate([[0], np.cumsum(length)])
    cuts = [0]
    for i in range(len(length)):
        if first[i + 1] - first[cuts[-1]] > SHARD_BYTES and i > cuts[-1]:
            cuts.append(i)
    shards = [Shard(data[first[a] : first[b]], length[a:b], WIDTH) for a, b in zip(cuts, [*cuts[1:], len(length)], strict=True)]
    rows, starts = repeated_intervals(shards, WIDTH)
    # Rows to bytes of data: an end mark follows each string.
    place, base = [], 0
    for s in shards:
        place.append(s.order + base)
        base += s.n
    string = np.repeat(np.arange(len(length)), length + 1)
    offset = np.arange(len(string)) - np.repeat(first[:-1] + np.arange(len(length)), length + 1)
    out = np.where(offset + WIDTH <= length[string], doc[string], LARGEST)
    if len(rows):
        place = np.concatenate(place)[rows]
        out[place] = np.repeat(np.minimum.reduceat(doc[string[place]], starts), np.diff([*starts, len(rows)]))
    return out[offset < length[string]]


def distinct_strings(data: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A number for each string, the same for equal strings; these have one key, which follows from the bytes. Strings are compared, not hashes."""
    raw, ends, seen = data.tobytes(), np.cumsum(length), {}
    number = seen.setdefault
    return np.array([number(raw[a:b], len(seen)) for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)], dtype=np.int64)


def earlier_windows(key: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, first and last-but-one start of runs of windows that a smaller doc has, too. All strings of a key are given."""
    same = distinct_strings(data, length)
    n = int(same.max()) + 1
    least = np.full(n, LARGEST)
    np.minimum.at(least, same, doc)
    example = np.zeros(n, dtype=np.int64)
    example[same] = np.arange(len(same))
    first = np.concatenate([[0], np.cumsum(length)])
    # Keys with several different strings are merged; in a key's single string all windows have the string's docs.
    of_key, counts = np.unique(key[example], return_counts=True)
    several = counts[np.searchsorted(of_key, key[example])] > 1
    chosen = np.flatnonzero(several)
    chosen = chosen[np.argsort(key[example[chosen]], kind="stable")]
    minima = np.repeat(least, length[example])
    before = np.concatenate([[0], np.cumsum(length[example])])
    size = np.cumsum(length[example[chosen]])
    keys = key[example[chosen]]
    a = 0
    while a < len(chosen):
        b = int(np.searchsorted(size, (size[a - 1] if a else 0) + MERGE_BYTES, side="right"))
        b = max(b, a + 1)
        while b < len(chosen) and keys[b] == keys[b - 1]:
            b += 1
        part = example[chosen[a:b]]
        got = window_minima(np.concatenate([data[first[i] : first[i + 1]] for i in part]), length[part], least[chosen[a:b]])
        at = 0
        for c, i in zip(chosen[a:b].tolist(), part.tolist(), strict=True):
            minima[before[c] : before[c] + length[i]] = got[at : at + length[i]]
            at += length[i]
        a = b
    # Back to every string: windows whose smallest doc is below its own.
    take = np.repeat(before[same] - first[:-1], length) + np.arange(len(data))
    offset = np.arange(len(data)) - np.repeat(first[:-1], length)
    hit = (minima[take] < np.repeat(doc, length)) & (offset + WIDTH <= np.repeat(length, length))
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # A run of hits never crosses strings: the last WIDTH - 1 offsets of each are no windows.
    string = np.searchsorted(first, begin, side="right") - 1
    return string, start[string] + begin - first[string], start[string] + end - first[string]


def found_ranges(parts: DataFrame) -> DataFrame:
    """doc_id, text_hash and packed pairs of 32-bit integers: bytes from the first up to the second are to go. Texts of one doc_id have rows of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, [[], [], [], [], [], []]
        kinds = (np.uint64, np.int64, np.int64, "<u4", "<u4", np.uint8)

        def found() -> Iterator[pa.RecordBatch]:
            """In chunks of whole keys, so that what is worked on has a bounded size."""
            key, doc, text, start, length, data = (np.concatenate(x) for x in held)
            length = length.astype(np.int64)
            first, order = np.cumsum(length) - length, np.argsort(key, kind="stable")
            size, keys, a = np.cumsum(length[order]), key[order], 0
            while a < len(order):
                b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + MERGE_BYTES, side="right")))
                b = int(np.searchsorted(keys, keys[b - 1], side="right"))
                o = order[a:b]
                part = np.concatenate([data[i : i + n] for i, n in zip(first[o].tolist(), length[o].tolist(), strict=True)])
                string, begin, end = earlier_windows(key[o], doc[o], start[o].astype(np.int64), length[o], part)
                yield told(doc[o][string], text[o][string], begin, end)
                a = b

        def told(doc: np.ndarray, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            order = np.lexsort([text, doc])
            doc, text, pairs = doc[order], text[order], np.stack([a, b + WIDTH - 1], axis=1)[order].astype("<u4")
            at = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])])) if len(doc) else np.zeros(0, dtype=np.int64)
            ends = (8 * np.append(at, len(doc))).astype(np.int32)  # eight bytes a pair
            ranges = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(pairs.tobytes())])
            return pa.record_batch([pa.array(doc[at]), pa.array(text[at]), ranges], ["doc_id", "text_hash", "ranges"])

        for batch in batches:
            for p, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part and part is not None:
                    yield from found()
                    held = [[], [], [], [], [], []]
                part = p
                for x, v, kind in zip(held, packed, kinds, strict=True):
                    x.append(np.frombuffer(v, dtype=kind))
        if held[0]:
            yield from found()

    return parts.mapInArrow(run, "doc_id long, text_hash long, ranges binary")


def left_over(text: bytes, ranges: list[bytes]) -> tuple[bytes, int, int]:
    """What remains of text, the number of bytes removed and of maximal removed runs."""
    pairs = np.frombuffer(b"".join(ranges), dtype="<u4").reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
    begin, end = pairs[new, 0], reach[[*(new[1:] - 1), len(pairs) - 1]]
    kept, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        kept.append(text[at:a])
        at = b
    return b"".join([*kept, text[at:]]), int((end - begin).sum()), len(begin)


def part_count(n: int, total: int) -> int:
    """Parts of about PART_BYTES of text, a multiple of the n partitions; fewer where a task's rows for a part would get tiny."""
    return n * max(1, min(-(-total // (n * PART_BYTES)), SEND_BYTES // (n << 10)))


def by_part(rows: DataFrame, n: int) -> DataFrame:
    """Parts are dealt out evenly; a task takes its parts one after another."""
    return rows.repartitionById(n, F.col("part") % n).sortWithinPartitions("part")


def repeated_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_id, n_bytes, sha, first_doc) of each row, and (doc_id, text_id, ranges) of texts that lose bytes."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    rows = keyed(docs).select("doc_id", "text_id", F.xxhash64("text").alias("text_hash"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    rows = settle(rows, "rows")
    n_parts = part_count(n, rows.agg(F.sum("n_bytes")).first()[0] or 0)
    # The first document of each text stands for it. Rows without an id come before and after none.
    firsts = settle(rows.where("doc_id IS NOT NULL").groupBy("text_id", "text_hash").agg(F.min("doc_id").alias("first_doc")), "firsts")
    shared = shared_anchors(by_part(anchors_by_part(docs, n_parts), n)).groupBy("text_hash").agg(F.collect_list("anchors").alias("anchors"))
    shared = settle(shared.join(firsts, "text_hash").select(F.col("first_doc").alias("doc_id"), "text_id", "text_hash", "anchors"), "shared")
    # Texts are shuffled the same way at every size: what they are joined with grows with the input.
    wanted = keyed(docs).join(shared.hint("merge"), ["doc_id", "text_id"]).dropDuplicates(["doc_id", "text_id"]).select("doc_id", "text", "anchors", "text_hash")
    cut = by_part(cut_stretches(wanted, n_parts), n)
    ranges = found_ranges(cut).join(shared.select("doc_id", "text_id", "text_hash"), ["doc_id", "text_hash"]).groupBy("doc_id", "text_id").agg(F.collect_list("ranges").alias("ranges"))
    return rows.drop("text_hash").join(firsts.drop("text_hash"), "text_id", "left"), settle(ranges, "ranges")


def edited(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """doc_id, text_id, n, spans, kept and remaining of the texts with ranges."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                got = [left_over(t.encode(), r) for t, r in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                kept, n, spans = zip(*got, strict=True) if got else ((), (), ())
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array(kept, pa.binary())], ["doc_id", "text_id", "n", "spans", "kept", "remaining"])

    texts = keyed(docs).join(ranges.hint("merge"), ["doc_id", "text_id"]).dropDuplicates(["doc_id", "text_id"])
    return texts.select("doc_id", "text_id", "text", "ranges").mapInArrow(cut, "doc_id long, text_id binary, n long, spans long, kept string, remaining binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the repeated bytes cut out of text, and without the rows of which no word is left.

    Characters that a cut splits go with it. n_chars, where there is such a column, follows the text of changed rows.
    Whole texts meet the verdicts in one join.
    """
    rows, ranges = repeated_ranges(docs.select("doc_id", "text"))
    gone = rows.where((F.col("doc_id") > F.col("first_doc")) & (F.col("n_bytes") >= WIDTH)).select("doc_id", "text_id").distinct()
    verdicts = ranges.unionByName(gone.withColumn("ranges", F.array().cast("array<binary>"))).toDF("cut_id", "cut_text", "cut_ranges")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, ranges: pd.Series) -> pd.Series:
        """Null where nothing is cut."""
        return pd.Series([None if r is None else left_over(t.encode(), list(r))[0].decode(errors="ignore") if len(r) else "" for t, r in zip(texts, ranges, strict=True)], dtype=object)

    text = F.coalesce(docs["text"], F.lit(""))
    joined = docs.join(verdicts.hint("merge"), (docs["doc_id"] == verdicts["cut_id"]) & (id_of(text) == verdicts["cut_text"]), "left")
    # Not deterministic, as far as the planner knows: it shall not run the cut a second time for the filter.
    left = cut.asNondeterministic()(F.when(F.col("cut_ranges").isNotNull(), text), F.col("cut_ranges"))
    joined = joined.select(F.struct(*[docs[c] for c in docs.columns]).alias("cut_row"), left.alias("left_text")).where("left_text IS NULL OR " + f"rlike(left_text, r'{WORD}')")
    row, changed = F.col("cut_row"), F.col("left_text").isNotNull()
    new = {"text": F.coalesce("left_text", row["text"]), "n_chars": F.when(changed, F.length("left_text")).otherwise(row["n_chars"]) if "n_chars" in docs.columns else None}
    return joined.select(*[(new[c] if c in new else row[c]).alias(c) for c in docs.columns])


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and remaining (binary, null where the whole text remains) of each row.

    Null texts count as empty. Texts under WIDTH bytes lose nothing. Equal texts: the one with the smallest doc_id stands for
    them; the others lose all their bytes if they have WIDTH or more. Rows with the same doc_id aren't earlier
    than each other; rows with a null doc_id lose nothing and make no other lose anything. Only doc_id and text are read.
    """
    rows, ranges = repeated_ranges(docs)
    out = rows.join(edited(docs, ranges), ["doc_id", "text_id"], "left")
    gone = (F.col("doc_id") > F.col("first_doc")) & (F.col("n_bytes") >= WIDTH)
    whole = F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n", F.lit(0)))
    return out.select(
        "doc_id",
        "text_id",
        "n_bytes",
        whole.cast("long").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.lit(EMPTY)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
        F.when(gone, F.lit(b"")).otherwise(F.col("remaining")).alias("remaining"),
    )


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to earlier documents."""
    return deduplicate(documents(spark, sf_dir)).drop("remaining", "text_id")
