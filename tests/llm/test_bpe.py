import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from dirspark.llm import bpe
from dirspark.llm.bpe import Decoder, Encoder, merges_of, tokenizer_path


@pytest.fixture(scope="module")
def merges():
    return merges_of(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def texts():
    rng = random.Random(5)
    alphabets = ["ab", "aeth \n", "'sldmvetr ", "   \n\t　x", "éèñ ß", "01 2³", "!?'.-#$ a", "日本語テ 한", "<|endoftext|> a", "՘₏\U00010940\U0003fc36 a1!", "\U0001f600‍́a ", "\x85\xa0\x1c\x1f b "]
    for k in range(2500):
        yield "".join(rng.choice(rng.choice(alphabets) if k % 3 else alphabets[k % len(alphabets)]) for _ in range(rng.randrange(60)))
    yield from ["", " ", "<|endoftext|>", "a<|endoftext|>", "  <|endoftext|>  b", "x" * 40000, " " * 40000 + "y", "a   b  c \n d\n  e \n", "a\n ", "x\0y z", " \u3000 b",  "ab" * 20000 + " c", "é" * 30000, "\n" * 20001, "=" * 33333 + "'ll", "7" * 20000 + "a"]


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_encoding_equals_the_library(merges, library, chunk):
    encoder = Encoder(merges)
    for t in texts():
        if chunk == 1 and len(t) > 25000:
            continue
        ids = np.frombuffer(encoder.encode(t, chunk), dtype="<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids, repr(t[:80])


def test_decoding_equals_the_library(merges, library):
    rng = random.Random(6)
    for _ in range(1500):
        ids = [rng.randrange(50257) for _ in range(rng.randrange(12))]
        got = "".join(Decoder(merges).decode(np.array(ids, dtype="<u4").tobytes(), step=2))
        assert got == library.decode(ids, skip_special_tokens=False)


def test_memory_stays_within_the_lookahead(merges):
    from dirspark.llm.bpe import WordTransducer

    rng, t, most = random.Random(7), WordTransducer(merges), 0
    look = merges.sufficient_lookahead()
    for _ in range(300):
        t.feed("".join(rng.choice("theandio") for _ in range(100)).encode())
        most = max(most, len(t.held))
    assert look < 100_000 and most <= 4 * merges.longest + look + 100


def test_emission_by_lookahead_equals_the_library():
    """Words longer than the lookahead, fed in parts: the same ids, and a bounded number of bytes held."""
    m, library, rng = bpe.merges_of(bpe.tokenizer_path()), Tokenizer.from_file(bpe.tokenizer_path()), random.Random(7)
    for k in range(30):
        word = ["".join(rng.choice("abth") for _ in range(1500)), "ing" * rng.randrange(200, 600), "".join(rng.choice("é日本ñ") for _ in range(500)), "-" * rng.randrange(300, 900) + "=" * 300][k % 4]
        t, data, out, at = bpe.WordTransducer(m), word.encode(), [], 0
        while at < len(data):
            end = at + rng.randrange(1, 200)
            out += t.feed(data[at:end])
            at = end
            assert len(t.held) <= 3 * t.lookahead + 200
        assert out + t.finish() == library.encode(word, add_special_tokens=False).ids


def test_digests_of_every_kind_of_row(docs, no_docs):
    library = Tokenizer.from_file(bpe.tokenizer_path())

    def want(r):
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        return r.doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()

    got = Counter(map(tuple, bpe.digests(docs).collect()))
    assert got == Counter(map(want, docs.collect())) and bpe.digests(no_docs).count() == 0
    assert bpe.encode_rows(no_docs).count() == 0
