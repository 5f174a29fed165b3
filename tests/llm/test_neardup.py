import random
import re

import numpy as np
from pyspark.sql import functions as F

from dirspark.llm import neardup
from dirspark.llm.neardup import near_duplicates
from dirspark.llm.shingles import shingle_sets


def brute(rows):
    def shingles(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            smallest[root(i)] = min(d, smallest.get(root(i), d))
    return sorted(((d, len(s), c := smallest.get(root(i)), d == c if c is not None else True) for i, (d, s) in enumerate(sets)), key=repr)


def corpus():
    rng = random.Random(11)
    vocabulary = [rng.choice("bcdfgh") + rng.choice("aeiou") + rng.choice("lmnrst") + str(k % 3) for k in range(300)]
    new = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    line, rows = new(14), []
    for _ in range(12):
        base = new(rng.choice([3, 6, 12, 40, 160, 400]))
        for _ in range(rng.choice([1, 2, 9, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append(" ".join(w).title() if rng.random() < 0.2 else "\n".join([" ".join(w[: len(w) // 2]), " ".join(w[len(w) // 2 :])]))
    rows += [" ".join(line + new(90)) for _ in range(80)]
    rows += [None, "", " \t\n", "one", "one", "One two", "a b c d", "a b c d e", rows[0]]
    ids = rng.sample(range(10000), len(rows))
    return list(zip(ids, rows, strict=True))


def run(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=repr)


def test_equals_all_pairs(spark):
    rows = corpus()
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_long_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 6)
    rows = corpus()
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_nulls_ties_and_other_columns(docs):
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty(no_docs):
    assert run(no_docs) == []


def test_bits_that_coincide_lose_no_link(spark):
    """Sets of 4 shingles with 3 in common, of which two fall on one of the 1024 bits, in one list of over three sets."""
    rng, found = random.Random(12), []
    bit = lambda v: int(np.uint32(v) * np.uint32(2654435761) >> np.uint32(22))
    sketch = lambda t: (shingle_sets([t.encode()])[0] >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        while len(found) < 3:
            w = [f"w{rng.randrange(10**6)}" for _ in range(7)]
            v = sketch(" ".join(w))
            if len({bit(x) for x in v}) < 3:
                found.append((w, v))
    lists = []
    for w, v in found:
        for _ in range(400):  # the same three shingles and another, which is the largest value: both keys are shared
            longer = [*w, f"x{rng.randrange(10**6)}"]
            x = sketch(" ".join(longer))
            if x[:3].tolist() == v.tolist() and bit(x[3]) not in {bit(y) for y in v}:
                lists.append((w, v, longer, x))
                break
    assert lists
    for w, v, longer, x in lists:
        rows = [(i, n, values) for i, (n, values) in enumerate([(3, v), (4, x)])]
        reps = spark.createDataFrame([(i, n, values.tobytes()) for i, n, values in rows], "node long, n_shingles long, sketch binary")
        key = int(neardup.keys_of(v)[:1].view(np.int64)[0])
        members = spark.createDataFrame([(key, i, i, 2) for i in range(2)], "key long, node long, label long, size long")
        assert [(r.a, r.b, r.j) for r in neardup.across(members, reps).collect()] == [(0, 1, 0.75)]


def test_rows_without_id_link(spark):
    words = [f"w{i}" for i in range(60)]
    x, z = [f"x{i}" for i in range(5)], [f"z{i}" for i in range(5)]
    near = [" ".join(w) for w in (words, [*words[:55], *x], [*z, *words[5:55], *x])]  # neighbours are similar, the ends aren't
    apart = [" ".join(f"y{k}{i}" for i in range(20)) for k in range(2)]
    rows = [(5, near[0]), (None, near[1]), (None, near[1]), (9, near[2]), (None, apart[0]), (None, apart[1]), (None, apart[1] + " z")]
    got = run(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got == brute(rows) and [r[2:] for r in got if r[0] == 9] == [(5, False)]


def test_a_list_that_task_borders_cut_is_told_whole(spark):
    """Members of a common key, in more tasks than one: each is told with its key, once."""
    rows = [(5, i, 10) for i in range(10)] + [(1, 100, 10), (1, 101, 10), (9, 200, 10), (9, 201, 10), (7, 300, 10)]
    lists = spark.createDataFrame(rows, "key long, node long, n int").repartitionByRange(6, "key", "node").sortWithinPartitions("key", "node")
    assert lists.select(F.spark_partition_id().alias("p"), "key").where("key = 5").select("p").distinct().count() > 1
    told = [(r.key, r.a) for r in neardup.first_pairs(lists).where("key IS NOT NULL").collect()]
    assert len(told) == len(set(told)) and {a for k, a in told if k == 5} == set(range(10))
