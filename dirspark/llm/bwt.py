"""Merging of Burrows-Wheeler transforms, on arrays.

A shard is a collection of byte strings with its sorted suffixes. For each row of its transform are known the two
bytes before the suffix and the row of the suffix that starts with them. Shards are merged by refining
an interleave: rows of all shards stand in an order that is right for the first h bytes; a stable
distribution by the two preceding bytes gives the order that is right for h + 2 bytes. No suffixes are
compared. The place where two neighbouring rows are first told apart gives their common
prefix, and runs of rows that are never told apart are the repeated intervals.
"""

from __future__ import annotations

import numpy as np


class Shard:
    """The suffix order of strings, each with an end mark of its own (earlier strings' marks are smaller)."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, depth: int | None = None):
        """data: the strings' bytes, one after another. An end mark is put behind each. With depth, rows are in the order of their first depth bytes only, which is all that merging to that depth asks of them."""
        n, ends = len(data) + len(lengths), np.cumsum(lengths + 1) - 1
        text = np.zeros(n, dtype=np.uint64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = data.astype(np.uint64) + np.uint64(1)
        self.text, self.n = text.astype(np.uint16), n
        self.start_of = np.repeat(ends - lengths, lengths + 1)
        self.end_of = np.repeat(ends, lengths + 1)
        self.order = self._sorted(text, depth)

    def _sorted(self, text: np.ndarray, depth: int | None) -> np.ndarray:
        """Prefix doubling, from 7 bytes on."""
        n, left = self.n, self.end_of - np.arange(self.n)
        key = np.zeros(n, dtype=np.uint64)
        for k in range(7):
            part = np.zeros(n, dtype=np.uint64)
            part[: max(0, n - k)] = text[k:]
            part[left < k] = 0
            key = key << np.uint64(9) | part
        ended, h = left < 7, 7
        while True:
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.ones(n, dtype=bool)
            new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ended[order][1:] if ended is not None else sorted_key[1:] != sorted_key[:-1]
            rank = np.empty(n, dtype=np.uint64)
            rank[order] = np.cumsum(new) - 1
            if new.all() or (depth is not None and h >= depth):
                return order
            after = np.zeros(n, dtype=np.uint64)
            after[: max(0, n - h)] = rank[h:]
            key, ended, h = rank * np.uint64(n) + after, None, 2 * h

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """In suffix order: position; the two bytes before it as one number; the row that starts with them (-1: none); the first two of the row itself if none leads to it, else -1."""
        at = self.order
        row_of = np.empty(self.n, dtype=np.int64)
        row_of[at] = np.arange(self.n)
        text = self.text.astype(np.int64)
        has = at - 2 >= self.start_of[at]
        before = np.maximum(at - 2, 0)
        pair = np.where(has, text[before] << 9 | text[np.minimum(before + 1, self.n - 1)], 0)
        leads = np.where(has, row_of[before], -1)
        own = np.where(at + 1 >= self.end_of[at], text[at] << 9, -1)
        return at, pair, leads, own


def compact(*keys: np.ndarray) -> list[np.ndarray]:
    """The keys' ranks among all their values, as 16-bit integers: fewer than 65536 byte pairs occur."""
    seen = np.unique(np.concatenate(keys))
    if len(seen) > 65535:
        return [np.searchsorted(seen, k).astype(np.uint32) for k in keys]
    table = np.zeros(int(seen[-1]) + 1, dtype=np.uint16)
    table[seen] = np.arange(len(seen), dtype=np.uint16)
    return [table[k] for k in keys]


def joined_rows(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of all shards, one shard after another: the two bytes before, the row that starts with them (-1: none), and own."""
    parts, first, leads = [s.rows() for s in shards], 0, []
    for s, p in zip(shards, parts, strict=True):
        leads.append(np.where(p[2] >= 0, p[2] + first, -1))
        first += s.n
    return np.concatenate([p[1] for p in parts]), np.concatenate(leads).astype(np.int32), np.concatenate([p[3] for p in parts])


def repeated_intervals(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the merged order that share their first depth bytes (an even number) with another row, and where each interval of equals starts.

    The same refinement as merge(), without the rows that are already alone: whatever starts with other bytes before a row
    that is alone is alone, too, and leaving rows out doesn't change the order of the others.
    """
    pair, leads, _ = joined_rows(shards)
    (key_of,) = compact(pair)
    rows, block, starts = np.arange(len(pair), dtype=np.int32), np.zeros(len(pair), dtype=np.int32), np.zeros(0, dtype=np.int64)
    for _ in range(0, depth, 2):
        moving = leads[rows] >= 0
        source = rows[moving]
        order = np.argsort(key_of[source], kind="stable")
        source, was = source[order], block[moving][order]
        key = key_of[source]
        new = np.ones(len(source) + 1, dtype=bool)
        new[1:-1] = (key[1:] != key[:-1]) | (was[1:] != was[:-1])
        held = ~(new[:-1] & new[1:])
        rows, first = leads[source[held]], new[:-1][held]
        block, starts = np.cumsum(first, dtype=np.int32), np.flatnonzero(first)
    return rows, starts


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all shards (numbered one shard after another) in the order of their first depth bytes, and the common
    prefix of each row with the one before it, depth at most."""
    pair, leads, own = joined_rows(shards)
    first = len(pair)
    fixed = np.flatnonzero(own >= 0).astype(np.int32)
    fixed_key, key_of = compact(own[fixed], pair)
    first_byte = np.unique(np.concatenate([own[fixed], pair])) >> 9
    goes = leads >= 0
    rows = np.arange(first, dtype=np.int32)
    block = np.zeros(first, dtype=np.int32)
    common = np.full(first, -1, dtype=np.int16)
    common[0] = 0
    fixed_block = np.full(len(fixed), -1, dtype=np.int32)
    for h in range(0, depth, 2):
        moving = goes[rows]
        source = rows[moving]
        key = np.concatenate([fixed_key, key_of[source]])
        order = np.argsort(key, kind="stable")
        key = key[order]
        was = np.concatenate([fixed_block, block[moving]])[order]
        rows = np.concatenate([fixed, leads[source]])[order]
        apart = np.flatnonzero((key[1:] != key[:-1]) | (was[1:] != was[:-1])) + 1
        new = apart[common[apart] < 0]
        if h == 0:  # told apart by the pair itself, at its first or second byte
            found = np.where(first_byte[key[new]] != first_byte[key[new - 1]], 0, 1)
        elif len(new):  # by what follows the pair, at the border last found between the two rows: 2 bytes before
            earlier = np.cumsum(common == h - 2, dtype=np.int32)
            place = np.concatenate([np.zeros(len(fixed), dtype=np.int64), np.flatnonzero(moving)])[order]
            found = np.where(earlier[place[new]] > earlier[place[new - 1]], h, h + 1)
        if len(new):
            common[new] = found
        block = np.zeros(first, dtype=np.int32)
        block[apart] = 1
        block = np.cumsum(block, dtype=np.int32)
    return rows, np.where(common < 0, depth, common)
