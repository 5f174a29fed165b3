"""MinHash near-dedup with bottom-k sketches from one hash function.

A document's set of shingle hashes is kept as its K smallest values, in order (their first 32 bits). Documents with
equal sets (equal size and 128 bits of two hashes of the set) are one class, a node. Inverted lists of retained values generate candidates: the key of a list is two values that
follow each other among the LISTED smallest. Two sets of similarity 0.75 or more share such a pair unless no two neighbours
among the LISTED smallest values of their union are common (chance below 1e-15; for sets that their sketches
hold whole, never), while documents that only have a common line or passage seldom do.

Lists may be long, so a list never yields all its pairs. First its members are paired with the two smallest of
it. Candidates pass the union-sketch estimate, then the exact Jaccard index of the whole sets. In lists of more than
three whose members are still in more than one component, the pairs across components are then
compared by their sketches inside tasks, each pair in its first common list only, and those that pass are verified.
So every pair that shares a key is either compared or known to be connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.common import documents, settle, text_of
from dirspark.llm.components import components
from dirspark.llm.shingles import PLACES, mixed, shingle_sets

K, LISTED = 256, 64
#: Members of a list that are compared at once; longer lists are dealt out as pairs of blocks.
BLOCK = 4096
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Pairs whose estimate lies so many standard deviations below 0.75 aren't verified.
DEVIATIONS = 6.5
#: Lists that are broadcast at most, of two numbers each; more meet their members in a shuffle.
MOST_BROADCAST = 1 << 20
#: Bytes of text hashed at once.
STEP_BYTES = 1 << 20
TOP = np.uint32(0xFFFFFFFF)


def in_steps(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, int, list[bytes]]]:
    """Runs of rows with about STEP_BYTES of text: first row, end, and the texts as bytes (null: none)."""
    texts = batch.column(column).cast(pa.binary()).to_pylist()
    a, size = 0, 0
    for b, t in enumerate(texts, 1):
        size += len(t or b"")
        if size >= STEP_BYTES or b == len(texts):
            yield a, b, [x or b"" for x in texts[a:b]]
            a, size = b, 0


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


SET_KEY = ["set_id", "set_check", "n_shingles"]


def set_ids(s: np.ndarray) -> tuple[int, int]:
    """Two numbers for a set, by different sums over its hashes: equal for equal sets."""
    both = np.array([s.sum(dtype=np.uint64), np.bitwise_xor.reduce(s) if len(s) else 0, len(s), mixed(s * PLACES[9]).sum(dtype=np.uint64)], dtype=np.uint64)
    one = lambda k: int(mixed((mixed(both + PLACES[k : k + 4]) * PLACES[k + 4 : k + 8]).sum(dtype=np.uint64, keepdims=True)).view(np.int64)[0])
    return one(10), one(20)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_id and set_check (null for empty sets), sketch and text_id (a hash of the text) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in in_steps(batch):
                sets = shingle_sets(texts)
                first, second = zip(*(set_ids(s) if len(s) else (None, None) for s in sets), strict=True)
                sketch = [(s[:K] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets]
                columns = [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(sketch, pa.binary()), batch.column(2).slice(a, b - a)]
                yield pa.record_batch(columns, ["doc_id", "n_shingles", "set_id", "set_check", "sketch", "text_id"])

    rows = docs.select("doc_id", "text", F.xxhash64(text_of()).alias("text_id"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_id long, set_check long, sketch binary, text_id long")


def keys_of(sketch: np.ndarray) -> np.ndarray:
    v = sketch[:LISTED].astype(np.uint64)
    return mixed(v[:-1] * PLACES[7] + v[1:] * PLACES[8]) if len(v) > 1 else mixed(v)


def postings(reps: DataFrame) -> DataFrame:
    """A row for each key of each set: key, node, n (its size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [keys_of(np.frombuffer(x, dtype=np.uint32)) for x in batch.column(2).to_pylist()]
            counts = [len(x) for x in keys]
            if sum(counts):
                repeat = lambda c: np.repeat(np.asarray(batch.column(c)), counts)  # noqa: B023, E731
                yield pa.record_batch([signed(np.concatenate(keys)), pa.array(repeat(0)), pa.array(repeat(1).astype(np.int32))], ["key", "node", "n"])

    return reps.select("node", "n_shingles", "sketch").mapInArrow(run, "key long, node long, n int")


def first_pairs(lists: DataFrame) -> DataFrame:
    """From sorted lists: pairs (a, b) of each member with the first two, key null; and for lists of over three, each member (in a) with its key.

    A list may be cut by the border of two tasks. Each then pairs what it has, and members of a task's first and last list are always told, so that later rounds
    see the whole list.
    """

    def told(members: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(members), pa.array(members), pa.array(keys)], ["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, seen, heads, in_first = None, 0, np.zeros((3, 2), dtype=np.int64), True
        for batch in batches:
            key, node, n = (np.asarray(batch.column(i)).astype(np.int64) for i in range(3))
            if not len(key):
                continue
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.concatenate([starts, [len(key)]])))
            place = np.arange(len(key)) - starts[run_of]
            goes_on = open_key is not None and key[0] == open_key
            if goes_on:
                place[run_of == 0] += seen
            # The first three members of each run, node and size; those of a run that goes on are carried over.
            head = np.zeros((3, len(starts), 2), dtype=np.int64)
            if goes_on:
                head[:, 0] = heads
            for p in range(3):
                at = place == p
                head[p, run_of[at], 0], head[p, run_of[at], 1] = node[at], n[at]
            out = []
            for p in range(2):
                later = np.flatnonzero(place > p)
                other, size = head[p, run_of[later], 0], head[p, run_of[later], 1]
                ok = 100 * np.minimum(size, n[later]) >= PERCENT * np.maximum(size, n[later])
                a, b = other[ok], node[later][ok]
                out.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), dtype=np.int64))
            pairs = np.unique(np.concatenate(out, axis=1), axis=1)
            long_runs = run_of[place == 3]
            members = np.concatenate([head[p, long_runs, 0] for p in range(3)] + [node[place >= 3]])
            keys = np.concatenate([np.tile(key[starts[long_runs]], 3), key[place >= 3]])
            none = pa.nulls(pairs.shape[1], pa.int64())
            yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1]), none], ["a", "b", "key"])
            yield told(members, keys)
            if in_first and len(starts) > 1:
                in_first, size = False, int(place[starts[1] - 1]) + 1
                if size <= 3:
                    yield told(head[:size, 0, 0], np.full(size, key[0]))
            open_key, seen, heads = key[-1], int(place[-1]) + 1, head[:, -1]
        if open_key is not None and seen <= 3:
            yield told(heads[:seen, 0], np.full(seen, open_key))

    return lists.mapInArrow(run, "a long, b long, key long")


def padded(values: list[bytes]) -> np.ndarray:
    out = np.full((len(values), K), TOP)
    for i, x in enumerate(values):
        v = np.frombuffer(x, dtype=np.uint32)
        out[i, : len(v)] = v
    return out


def threshold(n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The least estimate that is verified: values are drawn from a union of bounded size without being put back."""
    j = PERCENT / 100
    union = np.maximum((n_a + n_b) / (1 + j), 2)
    return j - 1e-9 - DEVIATIONS * np.sqrt(j * (1 - j) / K * np.maximum(union - K, 0) / (union - 1))


def union_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of common values among the K smallest of each union; exact where the sketches hold the sets."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    new = np.ones(both.shape, dtype=bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    new &= both != TOP
    rank = np.cumsum(new, axis=1)
    common = ~new & (both != TOP) & (rank <= K)
    return common.sum(axis=1) / np.maximum(np.minimum(rank[:, -1], K), 1)


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs that pass the union-sketch estimate, with it."""
    of = lambda c: reps.select(F.col("node").alias(c), F.col("sketch").alias(f"s{c}"), F.col("n_shingles").alias(f"n{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                j = union_estimate(padded(part.column(2).to_pylist()), padded(part.column(3).to_pylist()))
                ok = pa.array(j >= threshold(np.asarray(part.column(4)), np.asarray(part.column(5))))
                yield pa.record_batch([part.column(0).filter(ok), part.column(1).filter(ok), pa.array(j).filter(ok)], ["a", "b", "j"])

    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb", "na", "nb").mapInArrow(run, "a long, b long, j double")


def fetch_sets(nodes: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """The whole set of each node, from the text of one document that has it."""
    ids = settle(nodes.join(reps.select("node", "pick", "set_id", "set_check"), "node").select("pick", "node", "set_id", "set_check"), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in in_steps(batch):
                sets = shingle_sets(texts)
                wanted = zip(*(batch.column(k).slice(a, b - a).to_pylist() for k in (2, 3)), strict=True)
                keep = [i for i, (s, w) in enumerate(zip(sets, wanted, strict=True)) if set_ids(s) == w]
                yield pa.record_batch([batch.column(0).slice(a, b - a).take(pa.array(keep, pa.int64())), pa.array([sets[i].tobytes() for i in keep], pa.binary())], ["node", "whole"])

    # A repeated doc_id may bring its other texts along: those have other sets. Equal texts bring the set twice; those without an id are taken once.
    no_id = docs.where("doc_id IS NULL").select(F.xxhash64(text_of()).alias("pick"), "text").dropDuplicates(["pick"])
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("pick"), "text").union(no_id)
    # The same join at every size: the sets that are wanted grow with the input.
    found = texts.join(ids.hint("merge"), "pick").select("node", "text", "set_id", "set_check").mapInArrow(run, "node long, whole binary")
    return settle(found, "sets")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    of = lambda c: sets.select(F.col("node").alias(c), F.col("whole").alias(f"s{c}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= PERCENT * (len(both) - common))
            ok = pa.array(ok, pa.bool_())
            yield pa.record_batch([batch.column(0).filter(ok), batch.column(1).filter(ok)], ["a", "b"])

    joined = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb")
    return joined.mapInArrow(run, "a long, b long").distinct()


def across(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b, j) of different components within each list of members(key, node, label, size) that pass the estimate."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "label")
    rows = dealt.join(reps.select("node", F.col("n_shingles").alias("n"), "sketch"), "node").select("key", "low", "high", "block", "node", "label", "n", "sketch")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pairs_of(key: tuple, in_block: list, nodes: list, labels: list, sizes: list, sk: list) -> Iterator[pa.RecordBatch]:
        block, two = np.array(in_block), key[1] != key[2]
        node, label, size, values = np.array(nodes), np.array(labels), np.array(sizes), padded(sk)
        keys = np.zeros((len(node), LISTED), dtype=np.uint64)
        for i, x in enumerate(sk):
            own = keys_of(np.frombuffer(x, dtype=np.uint32))
            keys[i, : len(own)] = own
        bits = np.zeros((len(node), 1024), dtype=bool)
        for k in range(K):
            used = values[:, k] != TOP
            bits[np.flatnonzero(used), values[used, k] * np.uint32(2654435761) >> np.uint32(22)] = True
        held_values = (values != TOP).sum(axis=1)
        # Values that fall on a bit another value of the set has: so many common ones may not show at most.
        hidden = held_values - bits.sum(axis=1)
        bits = np.packbits(bits, axis=1).view(np.uint64)
        # Numbers of the keys that come before this list's in each member, and one more for none: keys have the same order in all sketches.
        known, number = np.unique(keys, return_inverse=True)
        here = (keys == np.array([key[0]]).view(np.uint64)[0]).argmax(axis=1)
        before = np.where(np.arange(LISTED) < here[:, None], number.reshape(keys.shape), len(known)).astype(np.int32)
        marked = np.zeros(len(known) + 1, dtype=bool)
        for i in range(len(node) - 1):
            j = i + 1 + np.flatnonzero((label[i + 1 :] != label[i]) & ((block[i + 1 :] != block[i]) | (not two)) & (100 * np.minimum(size[i + 1 :], size[i]) >= PERCENT * np.maximum(size[i + 1 :], size[i])))
            for at in range(0, len(j), 4096):
                part = j[at : at + 4096]
                least = threshold(size[part], size[i])
                # A cheap bound first: the estimate counts common values that both sketches hold, out of as many as the larger has at least.
                common = np.bitwise_count(bits[part] & bits[i]).sum(axis=1, dtype=np.int64) + np.minimum(hidden[part], hidden[i])
                near = common >= least * np.maximum(held_values[part], held_values[i])
                part, least = part[near], least[near]
                if not len(part):
                    continue
                # Each pair in its first common list only.
                marked[before[i, : here[i]]] = True
                first = ~marked[before[part]].any(axis=1)
                marked[before[i, : here[i]]] = False
                part, least = part[first], least[first]
                if len(part):
                    estimate = union_estimate(np.repeat(values[i : i + 1], len(part), axis=0), values[part])
                    part, estimate = part[estimate >= least], estimate[estimate >= least]
                    yield pa.record_batch([pa.array(np.minimum(node[part], node[i])), pa.array(np.maximum(node[part], node[i])), pa.array(estimate)], ["a", "b", "j"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, ([], [], [], [], [])
        for batch in batches:
            for k, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k, low, high) != key:
                    yield from pairs_of(key, *held) if key is not None else ()
                    key, held = (k, low, high), ([], [], [], [], [])
                for x, v in zip(held, row, strict=True):
                    x.append(v)
        if key is not None:
            yield from pairs_of(key, *held)

    order = ["key", "low", "high"]
    return rows.repartition(n, *order).sortWithinPartitions(*order, "node").mapInArrow(run, "a long, b long, j double").dropDuplicates(["a", "b"])


def near_duplicates(docs: DataFrame, with_text_id: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of docs.

    Null and empty texts, and texts of white space, have no shingles, link with nothing and are kept. Rows with
    a null doc_id take part like others, but can't name a component: they have component_id null and are kept,
    unless a row with an id is in their component. Rows with the same doc_id are judged each by its text.
    Only doc_id and text are read.
    """
    rows = settle(sketches(docs).drop("sketch"), "rows")
    # One row stands for each set, picked by its id, or by its text where only rows without an id have the set. Sketches are made again for these rather than kept for all.
    firsts = rows.where("set_id IS NOT NULL").groupBy(*SET_KEY).agg(F.coalesce(F.min("doc_id"), F.min("text_id")).alias("pick"))
    firsts = settle(firsts.withColumn("node", F.monotonically_increasing_id()), "firsts")
    sketched = sketches(docs).withColumn("pick", F.coalesce("doc_id", "text_id")).drop("doc_id", "text_id")
    reps = settle(sketched.join(firsts, ["pick", *SET_KEY]).dropDuplicates(["node"]), "reps")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Ranges of key and node, so a key with a third of all members is many tasks.
    found = settle(first_pairs(postings(reps).repartitionByRange(n, "key", "node").sortWithinPartitions("key", "node")), "pairs")
    pairs = settle(estimated(found.where("key IS NULL").select("a", "b").distinct(), reps), "estimated")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = fetch_sets(nodes, reps, docs)
    labels = linked(pairs, sets, None)
    members = found.where("key IS NOT NULL").select("key", F.col("a").alias("node")).join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    members = settle(members, "members")
    open_lists = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("size")).where("x <> y").select("key", "size")
    open_lists = settle(open_lists, "lists")
    if open_lists.count() <= MOST_BROADCAST:  # members then stay where they are until their blocks are dealt
        open_lists = F.broadcast(open_lists)
    late = settle(across(members.join(open_lists, "key"), reps).join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "late")
    if not late.isEmpty():
        nodes = late.select(F.col("a").alias("node")).union(late.select("b")).distinct()
        more = sets.unionByName(fetch_sets(nodes.join(sets.select("node"), "node", "left_anti"), reps, docs))
        labels = linked(late, more, labels)
    classes = firsts.join(labels, "node", "left").select(*SET_KEY, F.coalesce("label", "node").alias("label"))
    named = rows.join(classes, SET_KEY, "left").select("doc_id", "n_shingles", "text_id", "label")
    smallest = named.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    out = named.join(smallest, "label", "left").select("doc_id", "n_shingles", *["text_id"] * with_text_id, F.coalesce("smallest", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def linked(pairs: DataFrame, sets: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labels after the pairs (a, b, j) are verified: the likeliest partner of each set first, then what is not yet connected."""
    best = settle(pairs.groupBy("b").agg(F.max(F.struct("j", "a")).alias("m")).select(F.col("m.a").alias("a"), "b"), "best")
    labels = components(verified(best, sets), labels)
    rest = settle(apart(pairs.join(best, ["a", "b"], "left_anti").select("a", "b"), labels), "rest")
    return labels if rest.isEmpty() else components(verified(rest, sets), labels)


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of docs that near_duplicates() keeps, with the columns of docs. Equal rows with one id all stay."""
    verdicts = near_duplicates(docs.select("doc_id", "text"), with_text_id=True)
    dropped = settle(verdicts.where("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("text_id").alias("gone_text")).distinct(), "dropped")
    same = docs["doc_id"].eqNullSafe(dropped["gone_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == dropped["gone_text"])
    # The same join at every size: what is dropped grows with the input.
    return docs.join(dropped.hint("merge"), same, "left_anti")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends aren't known to be connected."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    joined = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return joined.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates(documents(spark, sf_dir))
