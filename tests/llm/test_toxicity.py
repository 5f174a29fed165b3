import random
import zlib

import numpy as np
import pytest

from dirspark.llm import toxicity
from dirspark.llm.toxicity import STATE, STRIDE, WINDOW, Network, Scorer, sigmoid, windows_of
from rows import doc_rows


@pytest.fixture(scope="module")
def net():
    net = Network.new(3, 0.2)
    net.bias[:] = np.random.default_rng(1).standard_normal(net.bias.shape) * 0.2
    return net


def plain_logit(net, words):
    """One window, word by word, by the formulas of the gated unit."""
    xs = [net.word_inputs([w])[0] @ net.inputs + net.bias for w in words]
    sides = []
    for side, order in ((0, xs), (1, xs[::-1])):
        h, states = np.zeros(STATE), []
        for x in order:
            x, u = x[3 * STATE * side : 3 * STATE * (side + 1)], h @ net.states[side]
            r, z = (1 / (1 + np.exp(-(x[a : a + STATE] + u[a : a + STATE]))) for a in (0, STATE))
            h = z * h + (1 - z) * np.tanh(x[2 * STATE :] + r * u[2 * STATE :])
            states.append(h)
        sides.append(states if side == 0 else states[::-1])
    if not words:
        return float(net.shift[0])
    states = np.concatenate([np.array(sides[0]), np.array(sides[1])], axis=1)
    e = np.tanh(states @ net.attend) @ net.point
    weight = np.exp(e) / np.exp(e).sum()
    return float(weight @ states @ net.out + net.shift[0])


def plain_score(net, text):
    words = toxicity.WORD.findall((text or "").lower())
    starts = {*range(0, max(1, len(words) - WINDOW + 1), STRIDE), max(0, len(words) - WINDOW)}
    return float(sigmoid(np.float64(max(plain_logit(net, words[a : a + WINDOW]) for a in starts))))


def test_scores_are_those_of_the_worst_window(net):
    rng = random.Random(1)
    texts = [None, "", " .,", "one", "Ünd 日本 x_1 <b>", "w" * 5000] + [" ".join(rng.choice(["aa", "bb", "idiot", "c" * rng.randrange(1, 9)]) for _ in range(n)) for n in (63, 64, 65, 96, 97, 300)]
    got = Scorer(net).scores(texts)
    assert np.allclose(got, [plain_score(net, t) for t in texts], atol=2e-5)
    again = Scorer(net)
    assert np.allclose(np.concatenate([again.scores([t]) for t in reversed(texts)])[::-1], got, atol=1e-5)


def test_windows_overlap_and_cover_all_words():
    for n in range(400):
        starts = windows_of(n)
        assert starts == sorted(set(starts)) and {i for a in starts for i in range(a, min(n, a + WINDOW))} == set(range(n))
        assert all(b - a <= STRIDE for a, b in zip(starts, starts[1:])) and (n <= WINDOW or starts[-1] + WINDOW == n)


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = Network.new(1, 0.2)
    for name in ("inputs", "bias", "states", "attend", "point", "out", "shift"):
        setattr(net, name, getattr(net, name).astype(np.float64) + 0.1)
    gates, words = rng.standard_normal((9, 6 * STATE)), rng.integers(0, 9, (3, 5))
    mask = np.ones((3, 5))
    mask[1, 3:] = 0
    side = rng.standard_normal(3)
    value = lambda: float(net.run(gates, words, mask)[0] @ side)
    _, told = net.run(gates, words, mask, keep=True)
    d_gates, grads = net.back(told, side)
    by_row = np.zeros_like(gates)
    np.add.at(by_row, words.T.ravel(), d_gates.reshape(-1, 6 * STATE))
    for param, grad in [(gates, by_row), *((getattr(net, k), grads[k]) for k in ("states", "attend", "point", "out", "shift"))]:
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in param.shape)
            before = param[at]
            param[at] = before + 0.03
            up = value()
            param[at] = before - 0.03
            slope = (up - value()) / 0.06
            param[at] = before
            assert abs(slope - grad[at]) < 0.02 * max(0.05, abs(slope)), (slope, grad[at])


def test_learns_words_and_parts_of_words(spark):
    rng = random.Random(4)
    clean = ["the", "of", "sea", "house", "tree", "river"] + ["w%d" % k for k in range(60)]
    bad = ["idiot", "scum"] + ["grubbel" + rng.choice("abcdefgh") + rng.choice("aeiou") for _ in range(60)]
    rows, labels = [], []
    for k in range(900):
        ws = [rng.choice(clean) for _ in range(rng.randrange(5, 260))]
        y = k % 5 == 0
        if y:
            for _ in range(3):
                ws[rng.randrange(len(ws))] = rng.choice(bad)
        rows.append((k, " ".join(ws), "x"))
        labels.append((k, int(y)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(3)
    known = spark.createDataFrame(labels + labels[:50] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, known).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    held = [(got[k].predicted, y) for k, y in labels if got[k].held_out]
    assert len(held) > 150 and np.mean([p == y for p, y in held]) > 0.93
    # held-out labels are not looked at
    other = spark.createDataFrame([(k, 1 - y if got[k].held_out else y) for k, y in labels], "doc_id long, toxic int")
    assert all(abs(r.score - got[r.doc_id].score) < 1e-3 for r in toxicity.toxicity(docs, other).collect())


def test_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (6, 0), (100, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs.withColumn("held_out", docs.text), labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in doc_rows())
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert toxicity.toxicity(docs, labels.where("false")).count() == len(doc_rows())
