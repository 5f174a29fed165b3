import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from dirspark.llm import alignment
from dirspark.llm.bpe import byte_alphabet, tokenizer_path
from rows import doc_rows
from test_bpe import texts


def library():
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    return a, b, byte_alphabet()


def plain(text, tools):
    """Ids, and the groups found by comparing all token borders; None where the bytes differ."""
    a, b, alphabet = tools
    if not text:
        return None
    x, y = a.encode(" " + text, add_special_tokens=False), b.encode(text)
    bytes_a = [bytes(alphabet[c] for c in t) for t in x.tokens]
    pieces = [b.id_to_piece(i) for i in y]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
    if not b"".join(bytes_a) == (" " + text).encode() == b"".join(bytes_b):
        return None
    ends = [[sum(map(len, side[: i + 1])) for i in range(len(side))] for side in (bytes_a, bytes_b)] if len(text) < 3000 else [running(side) for side in (bytes_a, bytes_b)]
    both = set(ends[0]) & set(ends[1])
    sides = []
    for ids, at in ((x.ids, ends[0]), (y, ends[1])):
        groups, now = [], []
        for i, e in zip(ids, at, strict=True):
            now.append(i)
            if e in both:
                groups.append(now)
                now = []
        sides.append(groups)
    return list(zip(*sides, strict=True))


def running(side):
    out, n = [], 0
    for x in side:
        n += len(x)
        out.append(n)
    return out


def brute(rows):
    tools = library()
    found = [(d, plain(t, tools)) for d, t in rows]
    docs = defaultdict(int)
    for _, groups in found:
        for pair in {(i, j) for p, q in groups or [] for i in p for j in q}:
            docs[pair] += 1
    best = defaultdict(int)
    for (i, _), n in docs.items():
        best[i] = max(best[i], n)
    out = []
    for d, groups in found:
        groups = groups or []
        links = [(i, j) for p, q in groups for i in p for j in q]
        told = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        out.append((d, sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links), sum(docs[x] == best[x[0]] for x in links), sum(docs[x] for x in links), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return Counter(out)


def odd_texts():
    rng = random.Random(3)
    yield from [" ", "  ", "a ", " a", "a  b", "a \n b", "\n", "x▁y", "▁", "<|endoftext|> a", "<s> </s> <unk>", "<0x41> a", "a\0b c", "tab\tb c ", "日本語 テスト", "é" * 300, "=" * 700, "ab" * 500, "a\x1c b", "　 b", "don't  DON'T 12345 6.7"]
    yield from [t for t in texts() if len(t) < 3000 and rng.random() < 0.25]


@pytest.mark.parametrize("block", [1, 1 << 20])
def test_rows_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    rows = [(r[0], r[1]) for r in doc_rows()] + [(1000 + k, t) for k, t in enumerate(odd_texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, alignment.align(df).collect())) == brute(rows)


def test_forgetting_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 3)
    monkeypatch.setattr(alignment, "CALL_BYTES", 200)
    rows = [(r[0], r[1]) for r in doc_rows() if len(r[1] or "") < 3000]
    a = alignment.Aligner(tokenizer_path(alignment.A_FILE), tokenizer_path(alignment.B_FILE))
    b = alignment.Aligner(tokenizer_path(alignment.A_FILE), tokenizer_path(alignment.B_FILE))
    for _, t in rows * 2:
        facts, told, *_ = a.align([t])
        b.forget()
        again, same, *_ = b.align([t])
        assert facts.tolist() == again.tolist() and told == same


def test_empty_table_and_clashing_columns(spark, docs, no_docs):
    assert alignment.align(no_docs).count() == 0
    more = docs.withColumn("block", docs.doc_id).withColumn("is_doc", docs.text).withColumn("n", docs.text).withColumn("places", docs.text)
    assert Counter(map(tuple, alignment.align(more).collect())) == brute([(r[0], r[1]) for r in doc_rows()])
