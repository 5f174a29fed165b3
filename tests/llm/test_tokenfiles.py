import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from dirspark.llm import tokenfiles as tf
from dirspark.llm.bpe import tokenizer_path
from dirspark.llm.common import shared_dir


def expected(rows):
    t = Tokenizer.from_file(tokenizer_path())
    out = []
    for d, text, *_ in rows:
        out.append((d, np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4").tobytes()))
    return out


def test_files_hold_what_the_library_encodes(spark, docs):
    uri = f"{shared_dir(spark)}/tokens"
    manifest = tf.write(docs, uri, tokenizer_path(), 3)
    tf.write_manifest(manifest, uri)
    got = tf.scan(manifest, uri, zlib.crc32).collect()
    want = expected([r for r in docs.collect()])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(x) // 4, zlib.crc32(x)) for d, x in want)
    order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in order] == np.concatenate([[0], np.cumsum([r.n_tokens for r in order])])[:-1].tolist()
    keys = [-(1 << 63) if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    for key in (5, 8, None, 12345, -3):
        assert Counter(tf.lookup(spark, uri, key)) == Counter(x for d, x in want if d == key)


def test_lookup_reads_a_bounded_number_of_bytes():
    """Whatever the size, and never takes a key whose fingerprint alone agrees."""
    rng = np.random.default_rng(4)
    read = {}
    for n in (1000, 300_000):
        ids = np.sort(rng.choice(1 << 40, n, replace=False)).astype(np.int64)
        index = tf.ShardIndex.of(ids, np.zeros(n, dtype=bool), rng.integers(1, 9, n), 2)
        data = index.to_bytes()
        for k in (0, n // 3, n - 1):
            reader = tf.IndexReader(io.BytesIO(data))
            assert reader.find(int(ids[k])) == [(2 * int(index.offsets[k]), 2 * int(index.offsets[k + 1]))]
            read[n] = max(read.get(n, 0), reader.n_read)
        assert all(tf.IndexReader(io.BytesIO(data)).find(int(x)) == [] for x in ids[:50] + 1 if x not in ids)
        assert tf.IndexReader(io.BytesIO(data)).find(None) == []
        # A foreign key at a place whose fingerprint is made to agree: the stored id tells it apart.
        foreign = int(ids[1]) + 1
        at = index.phash.number(tf.key_of(np.array([foreign]), np.array([False])))[0]
        if at >= 0:
            index.phash.prints[at] = tf.fingerprint(np.array([foreign]))[0]
            assert tf.IndexReader(io.BytesIO(index.to_bytes())).find(foreign) == []
    assert max(read.values()) < 2048


def test_rows_without_ids_are_dealt_to_many_shards(spark):
    rows = spark.createDataFrame([(None if i % 2 else i, f"text {i}") for i in range(200)], "doc_id long, text string")
    uri = f"{shared_dir(spark)}/tokens"
    manifest = tf.write(rows, uri, tokenizer_path(), 8)
    tf.write_manifest(manifest, uri)
    assert manifest.where("n_null > 0").count() == 4
    got = sorted(tf.scan(manifest, uri, zlib.crc32).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 100 + list(range(0, 200, 2)) and len(tf.lookup(spark, uri, None)) == 100


@pytest.mark.parametrize("size", [1, 40, 1000])
def test_library_encoder_equals_the_library(monkeypatch, size):
    monkeypatch.setattr(tf.LibraryEncoder, "REMEMBERED", size)
    encoder, rng = tf.LibraryEncoder(tokenizer_path()), random.Random(size)
    pieces = [" ", "  ", "\n", "\t", "a", "foo", " <", "<|endoftext|>", "é", "日本", "\0", "\x85", "\xa0", "1", "'s", "!", "\u200b", " x" * 40, "z" * 300]
    for _ in range(40):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(20))) for _ in range(20)] + [None, ""]
        want = [np.array(encoder.library.encode(t or "", add_special_tokens=False).ids, dtype="<u2").tobytes() for t in texts]
        assert encoder.encode_batch(texts) == want


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 1000, 50000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        h = tf.PerfectHash.of(keys)
        assert sorted(h.number(keys)) == list(range(len(keys)))
        assert (h.find(keys) == h.number(keys)).all()
        if n:
            assert (h.find(keys + np.uint64(1)) >= 0).mean() < 0.01


def test_empty_table(spark, no_docs):
    uri = f"{shared_dir(spark)}/tokens"
    manifest = tf.write(no_docs, uri, tokenizer_path(), 3)
    tf.write_manifest(manifest, uri)
    assert tf.scan(manifest, uri, zlib.crc32).count() == 0


def test_stretches_are_dealt_by_their_blanks():
    """Texts with several blanks are dealt whole, and what is known isn't gone through again for each batch."""
    encoder, library = tf.LibraryEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    texts = [" a  b", " c d", " a\n", " e", " a ", " ", "  x", " <|endoftext|> y", "a<|endoftext|> b", None, "", " x\0y z", " " + "q" * 70 + " r", " é ü", "\n b c"]
    for _ in range(2):
        got = [np.frombuffer(x, dtype=encoder.kind).tolist() for x in encoder.encode_batch(texts)]
        assert got == [library.encode(x or "", add_special_tokens=False).ids for x in texts]
    # A dealt piece's own bytes are never counted: its ids are those up to the next blank.
    encoder.m = encoder.sizes = None
    assert [len(x) // encoder.width for x in encoder.dealt([" the", " of", " the"])] == [1, 1, 1]
    with pytest.raises(ValueError):
        encoder.dealt([" the of", " a"])
