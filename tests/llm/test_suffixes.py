import hashlib
import random

from dirspark.llm import suffixes
from dirspark.llm.suffixes import WIDTH, deduplicate


def brute(rows):
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, t in data:
        if d is not None:
            for i in range(len(t) - WIDTH + 1):
                w = t[i : i + WIDTH]
                first[w] = min(d, first.get(w, d))
    out = []
    for d, t in data:
        gone = bytearray(len(t))
        if d is not None:
            for i in range(len(t) - WIDTH + 1):
                if first[t[i : i + WIDTH]] < d:
                    gone[i : i + WIDTH] = b"\1" * WIDTH
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in deduplicate(df).collect()), key=repr)


def corpus():
    rng = random.Random(4)
    syllables = ["an", "the", "er", "ou", "é", "ti", " ", " ", "\n", ", "]
    new = lambda n: "".join(rng.choice(syllables) for _ in range(n))
    passages = [new(60) for _ in range(6)]
    rows = []
    for _ in range(150):
        t = new(rng.choice([5, 20, 30, 100, 300]))
        for _ in range(rng.choice([0, 1, 2, 3])):
            p = rng.choice(passages)
            a = rng.randrange(20)
            cut = rng.randrange(len(t) + 1)
            t = t[:cut] + p[a : a + rng.randrange(20, len(p))] + t[cut:]
        rows.append(t)
    rows += [rows[3], rows[3], rows[40][:-3], "x" * 49, "x" * 49, "x" * 50, "x" * 51, "x" * 400, "ab" * 90, "ba" * 90, None, "", rows[70] * 3]
    return list(zip(rng.sample(range(1000), len(rows)), rows, strict=True))


def test_equals_all_windows(spark):
    rows = corpus()
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_small_shards_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 200)
    rows = corpus()
    import numpy as np

    data = [t.encode() for _, t in rows if t and len(t.encode()) >= WIDTH]
    docs = [d for d, t in rows if t and len(t.encode()) >= WIDTH]
    got = suffixes.window_minima(np.frombuffer(b"".join(data), dtype=np.uint8), np.array([len(x) for x in data]), np.array(docs))
    want, first = [], {}
    for d, t in zip(docs, data, strict=True):
        for i in range(len(t) - WIDTH + 1):
            first[t[i : i + WIDTH]] = min(d, first.get(t[i : i + WIDTH], d))
    for t in data:
        want += [first[t[i : i + WIDTH]] if i + WIDTH <= len(t) else suffixes.LARGEST for i in range(len(t))]
    assert got.tolist() == want


def test_nulls_ties_and_other_columns(docs):
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_texts_of_one_id_lose_their_own_bytes(spark):
    rng = random.Random(8)
    new = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    p, q = new(120), new(120)
    rows = [(1, new(40) + p + new(30)), (2, q), (8, p + new(60)), (8, new(35) + p), (8, new(60)), (8, new(70) + q + new(20)), (8, "zzzz " + q), (9, new(60) + p[:80]), (9, q[20:90]), (7, p + q), (7, q + new(55))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert run(df) == brute(rows)
    left = sorted((r.doc_id, len(r.text)) for r in suffixes.without_repeats(df).collect())
    assert left == sorted((d, n - gone) for d, n, gone, _, _ in brute(rows) if n > gone)


def test_empty(no_docs):
    assert run(no_docs) == []
