import random
from collections import Counter

import numpy as np
import pytest

from dirspark.llm.bwt import Shard, merge, repeated_intervals


@pytest.mark.parametrize("seed", range(40))
def test_merged_order_prefixes_and_repeats(seed):
    rng, shards, rows = random.Random(seed), [], []
    for _ in range(rng.randrange(1, 5)):
        strings = [bytes(rng.choice(b"ab" if seed % 2 else b"abc\xff\x00") for _ in range(rng.randrange(25))) for _ in range(rng.randrange(1, 6))]
        shards.append(Shard(np.frombuffer(b"".join(strings), dtype=np.uint8), np.array([len(x) for x in strings])))
        suffixes = [x[i:] for x in strings for i in range(len(x) + 1)]
        own = [suffixes[p] for p in shards[-1].order]
        assert own == sorted(suffixes)
        rows += own
    for depth in (2, 6, 8):
        order, common = merge(shards, depth)
        got = [rows[r] for r in order]
        assert sorted(order) == list(range(len(rows))) and [g[:depth] for g in got] == sorted(g[:depth] for g in got)
        for i in range(1, len(got)):
            a, b, k = got[i - 1], got[i], 0
            while k < min(len(a), len(b), depth) and a[k] == b[k]:
                k += 1
            assert a == b or common[i] == k
        found, starts = repeated_intervals(shards, depth)
        counts = Counter(r[:depth] for r in rows if len(r) >= depth)
        ends = [*starts[1:], len(found)]
        assert sorted((rows[found[a]][:depth], b - a) for a, b in zip(starts, ends)) == sorted((k, n) for k, n in counts.items() if n > 1)
        assert all(len({rows[r][:depth] for r in found[a:b]}) == 1 for a, b in zip(starts, ends))
