"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Text is cut before blanks into stretches; neither tokenizer has a token that crosses such a cut, so a stretch is encoded and aligned by itself and remembered. Within it,
the B tokens' byte intervals are a static index (sorted starts and ends); a bisect for each A token's start and end
lists the B tokens that it overlaps. Gaps between B tokens that no A token spans are the borders of groups.

Links are counted over all documents without one row for each: a block of documents, the work of one task on BLOCK_BYTES of text, gives its distinct
pairs with the number of its documents that hold them. The sums over all blocks are shuffled by pair and go back to the
blocks that hold it, where they meet the documents as arrays. What is shuffled for a block is bounded by its text.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.bpe import AMONG_SPACES, merges_of, tokenizer_path
from dirspark.llm.common import documents, settle

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text in a block, and in one call of the tokenizers.
BLOCK_BYTES, CALL_BYTES = 8 << 20, 1 << 20
#: Stretches and their bytes that a Python worker remembers before it forgets all of them.
REMEMBERED, REMEMBERED_BYTES = 400_000, 24 << 20
#: The mark that the B file writes for a blank, a fixed value of its format.
BLANK = "▁"
BEFORE_BLANK = re.compile(r"(?<=\S)(?= )")
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>\Z")


def stretches(text: str) -> list[str]:
    """A text that begins with a blank, cut before each blank that follows something else than white space."""
    if "\0" in text or "  " in text or AMONG_SPACES.search(text):
        return BEFORE_BLANK.split(text)
    return text.replace(" ", "\0 ").split("\0")[1:]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, size of them, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, counted from 0, from the tokens' bytes in text order. Both cover the same bytes."""
    b_ends, a_ends = np.cumsum(b_sizes), np.cumsum(a_sizes)
    first = np.searchsorted(b_ends, a_ends - a_sizes, "right")
    last = np.searchsorted(b_ends - b_sizes, a_ends, "left") - 1
    change = np.bincount(first, minlength=len(b_ends)) - np.bincount(last, minlength=len(b_ends))
    unspanned = np.cumsum(change)[:-1] == 0
    of_b = np.concatenate([[0], np.cumsum(unspanned)])
    return of_b[first], of_b


class Aligner:
    """Aligns stretches and remembers them, as rows of arrays."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        known = merges_of(a_path).bytes_of
        self.a_bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(BLANK in x.lstrip(BLANK) for x in pieces):
            raise ValueError("a piece holds a blank behind another character, so texts can't be cut there")
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.match(x)) else x.replace(BLANK, " ").encode() for x in pieces]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], dtype=np.int64) for side in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id(BLANK)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.pair_of: dict[int, int] = {}
        self.pairs: list[int] = []
        #: n_a, n_b, n_groups, n_links and whether the bytes agree, by stretch; then the pairs of all stretches and where each one's begin.
        self.facts, self.texts = np.zeros((0, 5), dtype=np.int64), []
        self.linked, self.times, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode(self, new: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        simple = [i for i, x in enumerate(new) if len(x) <= 64 and x[1:2].strip()]
        a: list = [None] * len(new)
        if simple:  # one text for the library: no token crosses the cuts
            ids = np.array(self.a.encode_batch_fast(["".join([new[i] for i in simple])], add_special_tokens=False)[0].ids, dtype=np.int64)
            ends, want = np.cumsum(self.a_sizes[ids]), np.cumsum([len(new[i].encode()) for i in simple])
            at = np.searchsorted(ends, want) + 1
            if len(ends) < at[-1] or (ends[at - 1] != want).any():
                raise ValueError("a token crosses the border of two stretches")
            ids = ids.tolist()
            for i, p, q in zip(simple, [0, *at[:-1].tolist()], at.tolist(), strict=True):
                a[i] = ids[p:q]
        other = [i for i, x in enumerate(a) if x is None]
        for i, x in zip(other, self.a.encode_batch_fast([new[i] for i in other], add_special_tokens=False), strict=True):
            a[i] = x.ids
        b = self.b.encode([x[1:] for x in new], num_threads=1)  # the library adds the blank, but not to nothing
        return a, [ids or [self.blank] for ids in b]

    def learn(self, new: list[str]) -> None:
        a, b = self.encode(new)
        agree = [b"".join([self.a_bytes[i] for i in x]) == (t := s.encode()) == b"".join([self.b_bytes[i] for i in y]) for s, x, y in zip(new, a, b, strict=True)]
        kept = [k for k, ok in enumerate(agree) if ok]
        facts = np.zeros((len(new), 5), dtype=np.int64)
        n_pairs, texts = np.zeros(len(new), dtype=np.int64), [b""] * len(new)
        linked, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if kept:
            n_a, n_b = (np.array([len(side[k]) for k in kept]) for side in (a, b))
            a_ids, b_ids = (np.array([i for k in kept for i in side[k]], dtype=np.int64) for side in (a, b))
            of_a, of_b = groups_of(self.a_sizes[a_ids], self.b_sizes[b_ids])
            size_a, size_b = np.bincount(of_a), np.bincount(of_b)
            from_a, from_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
            owner = np.repeat(np.arange(len(kept)), n_a)[from_a]  # the stretch of each group
            n_groups = np.bincount(owner, minlength=len(kept))
            n_links = np.bincount(owner, weights=size_a * size_b, minlength=len(kept)).astype(np.int64)
            facts[kept] = np.column_stack([n_a, n_b, n_groups, n_links, np.ones(len(kept), np.int64)])
            la, lb, fa, fb = (x.tolist() for x in (size_a, size_b, from_a, from_b))
            sa, sb = [*map(str, a_ids.tolist())], [*map(str, b_ids.tolist())]
            told = [f"{','.join(sa[p : p + n])}|{','.join(sb[q : q + m])}" for p, n, q, m in zip(fa, la, fb, lb, strict=True)]
            at = 0
            ids_a, ids_b, pair_of = a_ids.tolist(), b_ids.tolist(), self.pair_of
            all_linked, all_times = [], []
            for k, n in zip(kept, n_groups.tolist(), strict=True):
                texts[k] = ";".join(told[at : at + n]).encode()
                found: dict[int, int] = {}
                for g in range(at, at + n):
                    if la[g] == lb[g] == 1:
                        key = ids_a[fa[g]] << 32 | ids_b[fb[g]]
                        found[key] = found.get(key, 0) + 1
                    else:  # repeated ids of a long group are multiplied, not listed
                        for x, c in counted(ids_a[fa[g] : fa[g] + la[g]]).items():
                            for y, d in counted(ids_b[fb[g] : fb[g] + lb[g]]).items():
                                key = x << 32 | y
                                found[key] = found.get(key, 0) + c * d
                for key, c in found.items():
                    if (p := pair_of.get(key)) is None:
                        p = pair_of[key] = len(self.pairs)
                        self.pairs.append(key)
                    all_linked.append(p)
                    all_times.append(c)
                n_pairs[k] = len(found)
                at += n
            linked.append(np.array(all_linked, dtype=np.int64))
            times.append(np.array(all_times, dtype=np.int64))
        base = len(self.texts)
        self.known.update(zip(new, range(base, base + len(new)), strict=True))
        self.facts = np.concatenate([self.facts, facts])
        self.linked, self.times = np.concatenate([self.linked, *linked]), np.concatenate([self.times, *times])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(n_pairs)])
        self.texts += texts
        self.held += sum(len(x) + len(y) for x, y in zip(new, texts, strict=True))

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For each text the facts (n_a, n_b, n_groups, n_links) and the hash of its groups; then (text's place, pair, times), sorted and summed."""
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES or len(self.pairs) > 2 * REMEMBERED:
            self.forget()
        parts = [stretches(" " + x) if x else [] for x in texts]
        if new := list(set().union(*parts) - self.known.keys()):
            self.learn(new)
        known = self.known
        rows = [[known[x] for x in part] for part in parts]
        sizes = np.array([len(x) for x in rows])
        flat, of = np.array([i for x in rows for i in x], dtype=np.int64), np.repeat(np.arange(len(rows)), sizes)
        agree = np.bincount(of, weights=self.facts[flat, 4] == 0, minlength=len(rows)) == 0
        agree &= sizes > 0
        facts = np.column_stack([np.bincount(of, weights=self.facts[flat, k], minlength=len(rows)) for k in range(4)]).astype(np.int64) * agree[:, None]
        told = [hashlib.sha256(b";".join([self.texts[i] for i in x])).hexdigest() if ok else "" for x, ok in zip(rows, agree.tolist(), strict=True)]
        use = agree[of]
        cells, n = np.unique(of[use] * len(self.texts) + flat[use], return_counts=True)
        text, stretch = np.divmod(cells, max(1, len(self.texts)))
        many = self.begin[stretch + 1] - self.begin[stretch]
        at = spread(self.begin[stretch], many)
        width = max(1, len(self.pairs))
        cells, where = np.unique(np.repeat(text, many) * width + self.linked[at], return_inverse=True)
        times = np.bincount(where, weights=np.repeat(n, many) * self.times[at], minlength=len(cells)).astype(np.int64)
        return facts, told, cells // width, cells % width, times


def counted(ids: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for x in ids:
        out[x] = out.get(x, 0) + 1
    return out


@lru_cache(maxsize=1)
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """One for each Python worker; without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(a_path, b_path)


def calls(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about CALL_BYTES of text."""
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CALL_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def aligned_blocks(docs: DataFrame, text: str, carry: list[str], a_path: str, b_path: str) -> DataFrame:
    """Rows of documents (carry and their facts, with pairs as places in their block's list) and one row for each block (keys and n_docs).

    block is made of the partition's number and a running number, so a repeated attempt of a task names its blocks alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = aligner_of(a_path, b_path), TaskContext.get().partitionId()
        number, held, size = 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = task << 32 | number
            keys, places = np.unique(np.concatenate([k for _, _, _, _, k, _ in held]), return_inverse=True)
            n_docs = np.bincount(places, minlength=len(keys))
            at = 0
            for rows, facts, told, of, k, times in held:
                n, ends = rows.num_rows, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows.num_rows))])
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, kind)) for x, kind in ((places[at : at + len(k)], pa.int32()), (times, pa.int64()))]
                numbers = [pa.array(facts[:, i]) for i in range(4)]
                yield pa.record_batch([*rows.columns, *numbers, pa.array(told, pa.string()), pa.array(np.full(n, block)), *lists, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names)
                at += len(k)
            rows = held[0][0]
            columns = [pa.nulls(1, x.type) for x in rows.columns] + [pa.nulls(1, pa.int64())] * 4 + [pa.nulls(1, pa.string()), pa.array([block], pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))]
            yield pa.record_batch([*columns, pa.array([keys], pa.list_(pa.int64())), pa.array([n_docs], pa.list_(pa.int64()))], names)

        for batch in batches:
            for part in calls(batch, text_sizes(batch.column(0))):
                facts, told, of, pairs, times = aligner.align(part.column(0).to_pylist())
                rows = pa.record_batch([*part.columns[1:], pa.array(np.ones(part.num_rows, dtype=bool))], [*carry, "is_doc"])
                held.append((rows, facts, told, of, np.array(aligner.pairs, dtype=np.int64)[pairs] if len(pairs) else np.zeros(0, np.int64), times))
                size += int(text_sizes(part.column(0)).sum()) + 64 * part.num_rows
                if size >= BLOCK_BYTES:
                    yield from flush()
                    number, held, size = number + 1, [], 0
        if held:
            yield from flush()

    names = [*carry, "is_doc", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "places", "times", "keys", "n_docs"]
    rows = docs.select(F.col(text).alias("text"), *carry)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{kept}, is_doc boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, places array<int>, times array<long>, keys array<long>, n_docs array<long>")


def align(docs: DataFrame, text: str = "text", key: str = "doc_id", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """One row for each row of docs: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Each row counts as a document, so rows with a null or repeated key each have their own. Null and empty texts, and texts that either tokenizer's bytes don't give back, have zeros
    and an empty hash. Of ties for an A id's highest count all are best. No columns but key and text are read, so extra ones don't matter. An empty table gives none.
    """
    blocks = settle(aligned_blocks(docs, text, [key], tokenizer_path(a_file), tokenizer_path(b_file)))
    held = blocks.where(F.col("is_doc").isNull()).select("block", F.posexplode(F.arrays_zip("keys", "n_docs")).alias("place", "x")).select("block", "place", F.col("x.keys").alias("pair"), F.col("x.n_docs").alias("n"))
    counts = held.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("best", F.max("n").over(Window.partitionBy(F.shiftright("pair", 32))) == F.col("n"))
    told = held.drop("n").join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n", "best")
    rows = blocks.where("is_doc").select(key, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "places", "times")

    def meet(docs: pa.Table, counts: pa.Table) -> pa.Table:
        size = counts.num_rows
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = counts.column("place").to_numpy()
        n[at], best[at] = counts.column("n").to_numpy(), counts.column("best").to_numpy()
        docs = docs.combine_chunks()
        places, times = (docs.column(c).combine_chunks() for c in ("places", "times"))
        of, many = places.flatten().to_numpy(), times.flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(places.value_lengths().to_numpy())])
        sums = [np.concatenate([[0], np.cumsum(many * x[of])]) for x in (best, n)]
        found = [pa.array(x[ends[1:]] - x[ends[:-1]]) for x in sums]
        return pa.table([*(docs.column(c) for c in (key, "n_a", "n_b", "n_groups", "n_links")), *found, docs.column("groups_sha256")], [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.groupBy("block").cogroup(told.groupBy("of_block")).applyInArrow(meet, f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
