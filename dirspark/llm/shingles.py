"""Hashes of words and of word shingles, for whole batches of texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: White space is the space and the controls 9-13; A-Z are lowered.
GAPS = (9, 10, 11, 12, 13, 32)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(GAPS)] = False
STEP = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(STEP))
PLACES = mixed(np.arange(1001, 1129, dtype=np.uint64)) | np.uint64(1)


@lru_cache(maxsize=2)
def powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and STEP**-i modulo 2**64 for i below 2**log2."""
    out = []
    for base in (STEP, pow(STEP, -1, 1 << 64)):
        x = np.ones(1, dtype=np.uint64)
        for _ in range(log2):
            x = np.concatenate([x, x * np.uint64(pow(base, len(x), 1 << 64))])
        out.append(x)
    return tuple(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of all texts, and the number of words before each text and after the last."""
    data = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    data = LOWER[data]
    word = IS_WORD[data]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = powers(max(16, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * power[: len(data)], dtype=np.uint64)])
    hashes = mixed((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.concatenate([[0], np.searchsorted(start, ends)]).astype(np.int64)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each text: of all its words as one if they are fewer than width."""
    words, first = word_hashes(texts)
    if len(words) >= width:
        sums = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            sums += words[k : len(words) - width + 1 + k] * PLACES[k]
        shingles = mixed(sums)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(shingles[a : b - width + 1]))
        elif b > a:
            out.append(mixed((words[a:b] * PLACES[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
