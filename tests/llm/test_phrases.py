import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from dirspark.llm import phrases
from rows import doc_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000):
    """All phrases of all lengths counted, by the words of the contract."""
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cands = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    dropped = set()
    for (lang, ws), a in cands.items():
        for size in range(2, len(ws)):
            for i in range(len(ws) - size + 1):
                if 100 * a >= 100 * f[lang, ws[i : i + size]]:
                    dropped.add((lang, ws[i : i + size]))
    out = []
    for (lang, ws), a in cands.items():
        if (lang, ws) not in dropped:
            n = total[lang]
            score, k = min((1000 * a * n // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws)))
            out.append((lang, -score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]], n))
    out.sort()
    ranks = Counter()
    found = []
    for lang, score, a, phrase, left, right, n in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            found.append((lang, ranks[lang], phrase.decode(), -a, left, right, n, -score))
    return found


def random_rows(n=400):
    rng = random.Random(11)
    ws = ["of", "The", "new", "YORK", "city", "é", "Ünd", "a", "b", "\x85x", "日本", "<s>", "x\0y"]
    marks = [" ", "  ", "\t", " ", " ", " ", " ", ", ", ".", "\n", "\r\n", "!", " \x0b"]
    rows = [("".join(rng.choice(ws) + rng.choice(marks) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [("New York City of dreams. " * 30, "en"), ("one two three four five six " * 40, None), (None, "en"), ("", None), (" \n. ", "de")]


@pytest.mark.parametrize("buckets,block", [(1 << 24, 1 << 20), (1 << 16, 50)])
def test_equals_all_counts(spark, monkeypatch, buckets, block):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
    monkeypatch.setattr(phrases, "REMEMBERED", 5 if block == 50 else 1000)
    rows = random_rows()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert sorted(map(tuple, phrases.collocations(df, least=12, top=40, buckets=buckets).collect())) == sorted(brute(rows, 12, top=40))


def test_rows_with_clashing_columns(spark, docs, no_docs):
    more = docs.withColumn("phrase", docs.doc_id).withColumn("n", docs.text).withColumn("k", docs.text).withColumn("range", docs.text)
    got = phrases.collocations(more, least=20).collect()
    assert got and sorted(map(tuple, got)) == sorted(brute([(r[1], r[2]) for r in doc_rows()], 20))
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(docs, least=10**9).count() == 0


def test_phrases_with_one_hash_are_told_apart():
    ids = np.array([1, 2, 3, 1, 2, 4, 5, 3, 4])
    first, n = phrases.distinct(ids, np.arange(8), np.zeros(8, dtype=np.uint64), 2)
    assert Counter({(ids[p], ids[p + 1]): c for p, c in zip(first, n)}) == Counter(zip(ids[:-1], ids[1:]))


def test_large_counts_stay_exact(spark):
    a, n, left, right = 3 * 10**12 + 1, 10**15 + 7, 5 * 10**12 + 3, 4 * 10**12 + 9
    got = spark.range(1).selectExpr(f"(cast(1000 as decimal(4, 0)) * cast({a} as decimal(16, 0)) * cast({n} as decimal(16, 0))) div (cast({left} as decimal(16, 0)) * cast({right} as decimal(16, 0)))").first()[0]
    assert got == 1000 * a * n // (left * right)


def test_sql_twin(spark, tmp_path):
    rows = random_rows(3000)
    spark.createDataFrame(rows, "text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = [(*r[:3], *r[3:]) for r in con.sql(phrases.ORACLE).fetchall()]
    got = [tuple(r) for r in phrases.op13_phrases(spark, str(tmp_path)).collect()]
    assert got and sorted(got) == sorted(want)
