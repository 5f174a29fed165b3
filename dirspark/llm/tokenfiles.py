"""Token files: raw id payloads with a minimal perfect hash index.

A shard is two files. NAME.bin holds the ids of its documents, one after another, as little-endian unsigned
integers of 16 bits where the vocabulary allows it, else of 32. NAME.idx holds the offsets and a minimal perfect hash of the document keys: levels of bits
in which each key that is alone in its slot sets a bit, the rest going on to the next level. A key's
number is the count of bits before its own; counts before each BLOCK words are stored, so a lookup reads a
block of bits for each level it tests and one entry of each table, whatever the size. A fingerprint of each key is stored at its number, so
foreign keys are told apart at once; the few that pass (one in 2^32) are told apart by the id stored with the record.
Documents lie in ascending order of their ids over all shards; offsets of shards come from prefix sums, and the manifest has
each file's smallest and largest id, so a lookup opens only files that can hold its key.

Files are written under a name of the task attempt and then renamed, and a manifest lists the shards that
count: a lost or repeated task leaves nothing behind that is read.
"""

from __future__ import annotations

import os
import posixpath
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.bpe import AMONG_SPACES, merges_of, tokenizer_path
from dirspark.llm.common import documents, settle, shared_dir, text_of

#: Constants of the 64-bit mixer used for all hashes here.
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)
MAGIC = b"TOKIDX1\0"
#: Bits of a level for each key that reaches it.
GAMMA = 2
LEVELS = 48
END = 0
SHARD_BYTES = 64 << 20
#: Words of 64 bits whose counts are stored together.
BLOCK = 8
#: Texts encoded at once.
ROWS = 512


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * MIX[2] & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit keys to 0..n-1, and a 32-bit fingerprint of each."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray, prints: np.ndarray):
        self.levels, self.rest, self.prints = levels, rest, prints
        self.words, self.before, count = [], [], 0
        for bits in levels:
            sizes = np.bitwise_count(bits).astype(np.int64)
            self.before.append(count + np.concatenate([[0], np.cumsum(sizes)])[:-1])
            count += int(sizes.sum())
        self.in_levels = count

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        left, levels = keys.astype(np.uint64), []
        while len(left) and len(levels) < LEVELS:
            n_words = max(1, -(-GAMMA * len(left) // 64))
            slots = (mixed(left, len(levels)) % np.uint64(64 * n_words)).astype(np.int64)
            alone = np.bincount(slots, minlength=64 * n_words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[slots]]
        out = cls(levels, np.sort(left), np.zeros(len(keys), dtype="<u4"))
        numbers = out.number(keys)
        out.prints[numbers] = fingerprint(keys)
        return out

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for keys that no level has. Foreign keys may get a number: see find."""
        keys = keys.astype(np.uint64)
        out, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(open_):
                break
            slots = mixed(keys[open_], level) % np.uint64(64 * len(bits))
            word, bit = (slots >> np.uint64(6)).astype(np.int64), slots & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = self.before[level][word[hit]] + below
            open_ = open_[~hit]
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            ok = self.rest[at] == keys[open_]
            out[open_[ok]] = self.in_levels + at[ok]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key whose fingerprint agrees, else -1."""
        at = self.number(keys)
        ok = at >= 0
        ok[ok] = self.prints[at[ok]] == fingerprint(keys[ok])
        return np.where(ok, at, -1)


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def key_of(ids: np.ndarray, null: np.ndarray) -> np.ndarray:
    """64-bit keys of document ids, distinct for distinct ids; null has one of its own, found by its flag."""
    return np.where(null, np.uint64(1 << 63), ids.astype(np.int64).view(np.uint64))


class ShardIndex:
    """The index of one shard: records in order, for each distinct key its first record and number of records, and bytes for an id."""

    def __init__(self, offsets: np.ndarray, ids: np.ndarray, null: np.ndarray, phash: PerfectHash, first: np.ndarray, count: np.ndarray, width: int):
        self.offsets, self.ids, self.null, self.phash, self.first, self.count, self.width = offsets, ids, null, phash, first, count, width

    @classmethod
    def of(cls, ids: np.ndarray, null: np.ndarray, sizes: np.ndarray, width: int = 4) -> ShardIndex:
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
        keys = key_of(ids, null)
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        phash = PerfectHash.of(distinct)
        at = phash.number(distinct)
        by_number = np.empty((2, len(distinct)), dtype="<i8")
        by_number[0, at], by_number[1, at] = first, count
        return cls(offsets, ids.astype("<i8"), null.astype("u1"), phash, by_number[0], by_number[1], width)

    def to_bytes(self) -> bytes:
        p = self.phash
        levels = [x for bits, before in zip(p.levels, p.before, strict=True) for x in (bits.astype("<u8"), before[::BLOCK].astype("<u8"))]
        parts = [np.array([self.width], dtype="u1"), self.offsets, self.ids, self.null, self.first, self.count, p.prints, p.rest.astype("<u8"), *levels]
        head = MAGIC + struct.pack("<I", len(parts)) + b"".join(struct.pack("<2sQ", x.dtype.str[1:].encode(), x.nbytes) for x in parts)
        return head + b"".join(x.tobytes() for x in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> ShardIndex:
        if data[:8] != MAGIC:
            raise ValueError("not a token index")
        (n,) = struct.unpack_from("<I", data, 8)
        at, parts = 12 + 10 * n, []
        for k in range(n):
            kind, size = struct.unpack_from("<2sQ", data, 12 + 10 * k)
            parts.append(np.frombuffer(data, dtype="<" + kind.decode(), count=size // int(kind[1:]), offset=at))
            at += size
        width, offsets, ids, null, first, count, prints, rest, *levels = parts
        return cls(offsets, ids, null, PerfectHash(list(levels[::2]), rest, prints), first, count, int(width[0]))

    def records(self, ids: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First record and number of records of each key; (-1, 0) for keys that the shard lacks."""
        at = self.phash.find(key_of(ids, null))
        ok = at >= 0
        return np.where(ok, self.first[at], -1), np.where(ok, self.count[at], 0)


class IndexReader:
    """Lookups in an index file by seeking: a bounded number of bytes is read for each, whatever the size of the file."""

    def __init__(self, file):
        self.file, self.n_read = file, 0
        if self.read(0, 8) != MAGIC:
            raise ValueError("not a token index")
        (n,) = struct.unpack("<I", self.read(8, 4))
        head, at = self.read(12, 10 * n), 12 + 10 * n
        self.parts = []
        for k in range(n):
            kind, size = struct.unpack_from("<2sQ", head, 10 * k)
            self.parts.append((at, np.dtype("<" + kind.decode()), size // int(kind[1:])))
            at += size
        self.width = int(self.entry(0, 0))

    def read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        self.n_read += size
        return self.file.read(size)

    def entry(self, part: int, k: int, count: int = 1) -> np.ndarray | int:
        at, kind, _ = self.parts[part]
        got = np.frombuffer(self.read(at + k * kind.itemsize, count * kind.itemsize), dtype=kind)
        return got if count > 1 else int(got[0])

    def number(self, key: np.ndarray) -> int:
        for level, part in enumerate(range(8, len(self.parts), 2)):
            n_words = self.parts[part][2]
            slot = int(mixed(key, level)[0] % np.uint64(64 * n_words))
            word, bit = slot >> 6, slot & 63
            first = word // BLOCK * BLOCK
            bits = np.atleast_1d(self.entry(part, first, min(BLOCK, n_words - first))).astype(np.uint64)
            own = int(bits[word - first])
            if own >> bit & 1:
                return self.entry(part + 1, word // BLOCK) + int(np.bitwise_count(bits[: word - first]).sum()) + (own & (1 << bit) - 1).bit_count()
        a, b, want = 0, self.parts[7][2], int(key[0])
        n_rest = b
        while a < b:
            middle = (a + b) // 2
            a, b = (middle + 1, b) if self.entry(7, middle) < want else (a, middle)
        return self.parts[6][2] - n_rest + a if a < n_rest and self.entry(7, a) == want else -1

    def find(self, doc_id: int | None) -> list[tuple[int, int]]:
        """First and end byte in the payload of each record of doc_id."""
        key = key_of(np.array([doc_id or 0]), np.array([doc_id is None]))
        number = self.number(key)
        if number < 0 or self.entry(6, number) != int(fingerprint(key)[0]):
            return []
        first, count = self.entry(4, number), self.entry(5, number)
        if (None if self.entry(3, first) else self.entry(2, first)) != doc_id:
            return []
        ends = (self.width * self.entry(1, first, count + 1)).tolist()
        return list(zip(ends[:-1], ends[1:], strict=True))


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system that all executors share, and the path on it."""
    if urlparse(uri).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


def put(uri: str, name: str, data: list[bytes], attempt: str) -> None:
    """Write whole files only: under the attempt's name first, then renamed. Attempts write equal bytes."""
    fs, path = opened(uri)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(hidden := posixpath.join(path, f".{name}.{attempt}")) as f:
        for x in data:
            f.write(x)
    fs.move(hidden, posixpath.join(path, name))


def get(uri: str, name: str) -> bytes:
    fs, path = opened(uri)
    with fs.open_input_stream(posixpath.join(path, name)) as f:
        return f.read()


class LibraryEncoder:
    """Texts encoded by the tokenizers library, in batches; ids come as little-endian integers of width bytes.

    What stands before a blank never depends on what follows it, unless the blank stands among other white space. So texts are cut
    before blanks, and a batch's new stretches go to the library as one text; its ids are dealt to them by the blanks that tokens begin with. Other
    texts go to the library whole. Stretches of up to SHORT characters are remembered, two generations of REMEMBERED.
    """

    REMEMBERED, SHORT, JOINED = 900_000, 64, 1 << 20

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.m = merges_of(path)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = "<u2" if max(self.m.bytes_of) < 1 << 16 else "<u4"
        self.width = int(self.kind[2])
        sizes = self.m.token_bytes()[2]
        #: By id: whether a token begins with a blank, and whether it has one further on.
        self.begins, self.inside = np.zeros((2, len(sizes)), dtype=bool)
        for i, x in self.m.bytes_of.items():
            self.begins[i], self.inside[i] = x[:1] == b" ", b" " in x[1:]
        self.known, self.old = {}, {}

    def stretches(self, text: str) -> list[str]:
        """Pieces that can be encoded by themselves; special tokens are pieces of their own."""
        out, at = [], 0
        for hit in self.m.in_special.finditer(text):
            out += [*self.stretches(text[at : hit.start()]), hit[0]]
            at = hit.end()
        if at:
            return out + self.stretches(text[at:])
        return [text] if "\0" in text or AMONG_SPACES.search(text) else text.replace(" ", "\0 ").split("\0")

    def by_library(self, pieces: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype=self.kind) for x in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def dealt(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that each begin with a blank and have no other, encoded as one text: a piece's first token is one that begins with a blank."""
        (ids,) = self.by_library(["".join(pieces)])
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(pieces) or at[0] or self.inside[ids].any():
            raise ValueError("a token crosses the border of two stretches")
        raw, at = ids.tobytes(), [*(self.width * at).tolist(), self.width * len(ids)]
        return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def learn(self, new: list[str]) -> dict[str, bytes]:
        joined, other = [], []
        for x in new:
            (joined if not x.rfind(" ") and len(x) <= self.SHORT and x[1:2].strip() and x[1] != "<" else other).append(x)
        found = dict(zip(other, (x.tobytes() for x in self.by_library(other)), strict=True))
        for a in range(0, len(joined), step := self.JOINED // self.SHORT):
            found.update(zip(joined[a : a + step], self.dealt(joined[a : a + step]), strict=True))
        return found

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text. Null and empty texts have none."""
        parts = [self.stretches(x or "") for x in texts]
        new = set().union(*parts).difference(self.known)
        found = {x: self.old[x] for x in new & self.old.keys()}
        found |= self.learn(list(new.difference(found)))
        if len(self.known) + len(found) > self.REMEMBERED:
            self.old, self.known = self.known, {}
            found |= {x: self.old[x] for x in set().union(*parts) & self.old.keys()}
        ids = self.known
        ids |= found
        out = [b"".join(map(ids.__getitem__, part)) for part in parts]
        for x in found:
            if len(x) > self.SHORT:
                del ids[x]
        return out


@lru_cache(maxsize=1)
def library_encoder(path: str) -> LibraryEncoder:
    """One for each Python worker; without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return LibraryEncoder(path)


def token_counts(docs: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """carry and n_tokens: the number of ids of each row's text, by the library. Null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = [len(x) // encoder.width for x in encoder.encode_batch(part.column(0).to_pylist())]
                yield pa.record_batch([*part.columns[1:], pa.array(n, pa.int64())], [*carry, "n_tokens"])

    rows = docs.select("text", *carry)
    return rows.mapInArrow(run, rows.select(*carry).schema.add("n_tokens", "long"))


def encoded(docs: DataFrame, path: str, end: int = END, bounds: list[int] = (), null_shards: int = 1) -> DataFrame:
    """shard, doc_id, ids and width of each row, with the end id. Ids are 16-bit integers where all of the tokenizer's fit.

    Rows without an id come first: they are dealt to the first shards by a hash of their text.
    """
    edges = np.array(bounds, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(path)
        last = np.array([end], dtype=encoder.kind).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                keys = part.column(0).cast(pa.int64())
                by_text = ((np.asarray(part.column(2)).view(np.uint64) >> np.uint64(32)) * np.uint64(null_shards) >> np.uint64(32)).astype(np.int64)
                by_id = null_shards - 1 + np.searchsorted(edges, np.asarray(keys.fill_null(0)), side="right")
                shard = np.where(np.asarray(keys.is_null()), by_text, by_id)
                ids = [x + last for x in encoder.encode_batch(part.column(1).to_pylist())]
                yield pa.record_batch([pa.array(shard, pa.int32()), keys, pa.array(ids, pa.binary()), pa.array([encoder.width] * len(ids), pa.int32())], ["shard", "doc_id", "ids", "width"])

    return docs.select("doc_id", "text", F.xxhash64(text_of()).alias("text_hash")).mapInArrow(run, "shard int, doc_id long, ids binary, width int")


def shard_bounds(docs: DataFrame, n_shards: int) -> tuple[list[int], int]:
    """Where to cut the range of doc_ids (approximate quantiles, one number for each shard), and the number of shards for rows without one."""
    cuts = [k / n_shards for k in range(1, n_shards)] or [0.5]
    found, n, n_known = docs.agg(F.percentile_approx("doc_id", cuts, 10 * n_shards), F.count(F.lit(1)), F.count("doc_id")).first()
    return sorted(set(found or []))[: n_shards - 1], max(1, -(-n_shards * (n - n_known) // max(1, n)))


def write(docs: DataFrame, uri: str, path: str, n_shards: int | None = None) -> DataFrame:
    """Encode docs and write token files below uri; returns a row for each file: shard, part, name, counts, smallest and largest id.

    Shards are ranges of doc_id, so shard after shard is in ascending order. Documents are encoded once, before the
    shuffle. A task cuts a shard into files of about SHARD_BYTES. Null doc_ids come first, by a hash of the text; equal doc_ids are
    ordered by their ids' bytes.
    """
    n_shards = n_shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, null_shards = shard_bounds(docs, n_shards)
    ids = encoded(docs, path, END, bounds, null_shards)
    dealt = ids.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt = f"{context.stageId()}-{context.taskAttemptId()}"
        told, held, size, shard, number = [], [], 0, None, 0

        def flush() -> None:
            nonlocal held, size, number
            name = f"shard-{shard:06d}-{number:05d}"
            keys = pa.concat_arrays([x.column(1) for x in held])
            payload = [v for x in held for v in x.column(2).to_pylist()]
            width = held[0].column(3)[0].as_py()
            null = np.asarray(keys.is_null())
            index = ShardIndex.of(np.asarray(keys.fill_null(0)).astype(np.int64), null, np.array([len(x) // width for x in payload], dtype=np.int64), width)
            put(uri, f"{name}.bin", payload, attempt)
            put(uri, f"{name}.idx", [index.to_bytes()], attempt)
            known = keys.drop_null()
            told.append((shard, number, name, len(payload), size // width, int(null.sum()), known[0].as_py() if len(known) else None, known[-1].as_py() if len(known) else None))
            held, size, number = [], 0, number + 1

        for batch in batches:
            shards = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b and shards[a] != shard:
                    if held:
                        flush()
                    shard, number = int(shards[a]), 0
                for at in range(a, b, 1024):
                    held.append(part := batch.slice(at, min(1024, b - at)))
                    size += sum(map(len, part.column(2).to_pylist()))
                    if size >= SHARD_BYTES:
                        flush()
        if held:
            flush()
        if told:
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*told, strict=True), (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 5), strict=True)], ["shard", "part", "name", "n_docs", "n_ids", "n_null", "low", "high"])

    return settle(dealt.mapInArrow(run, "shard int, part int, name string, n_docs long, n_ids long, n_null long, low long, high long"), "manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids before each file. It has a row for each file of about 64 MB."""
    order = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))


def scan(manifest: DataFrame, uri: str, fold: Callable[[bytes], int]) -> DataFrame:
    """Read all files back: doc_id, start, n_tokens and fold(ids as 32-bit integers) of each record, found through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index, payload = ShardIndex.from_bytes(get(uri, f"{name}.idx")), get(uri, f"{name}.bin")
                distinct = np.unique(np.rec.fromarrays([index.null, index.ids]))
                first, count = index.records(distinct.f1.astype(np.int64), distinct.f0.astype(bool))
                order = np.argsort(first)
                records = np.repeat(first[order], count[order]) + np.concatenate([np.arange(c) for c in count[order]] or [np.zeros(0, np.int64)])
                begin, end = index.offsets[records], index.offsets[records + 1]
                ids = np.frombuffer(payload, dtype=f"<u{index.width}")
                folds = [fold(ids[b:e].astype("<u4").tobytes()) for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
                keys = pa.array(index.ids[records], pa.int64(), mask=index.null[records].astype(bool))
                yield pa.record_batch([keys, pa.array(begin + start, pa.int64()), pa.array(end - begin, pa.int64()), pa.array(folds, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    files = placed(manifest).select("name", "start")
    n = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(n, "name").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, uri: str, doc_id: int | None) -> list[bytes]:
    """The payloads of one document, as 32-bit integers, from the files whose ids can be its own."""
    known = F.col("n_null") > 0 if doc_id is None else F.lit(doc_id).between(F.col("low"), F.col("high"))
    out, (fs, path) = [], opened(uri)
    for (name,) in spark.read.parquet(f"{uri}/manifest").where(known).select("name").orderBy("name").collect():
        with fs.open_input_file(posixpath.join(path, f"{name}.idx")) as f:
            index = IndexReader(f)
            found = index.find(doc_id)
        if not found:
            continue
        with fs.open_input_file(posixpath.join(path, f"{name}.bin")) as f:
            for a, b in found:
                f.seek(a)
                out.append(np.frombuffer(f.read(b - a), dtype=f"<u{index.width}").astype("<u4").tobytes())
    return out


def write_manifest(manifest: DataFrame, uri: str) -> None:
    """The table manifest below uri: the files that count, with the number of ids before each."""
    placed(manifest).write.mode("overwrite").parquet(f"{uri}/manifest")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum in the token files, read back from them.

    Null and empty texts hold the end id alone. An empty table gives no files and no rows.
    """
    uri = f"{shared_dir(spark)}/tokens"
    manifest = write(documents(spark, sf_dir), uri, tokenizer_path())
    write_manifest(manifest, uri)
    return scan(manifest, uri, zlib.crc32)
