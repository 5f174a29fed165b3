"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word's input is the sum of a vector of its own and the mean of vectors of its characters' n-grams (3 to 5 long, borders
included), both from hashed tables, so words never seen before have an input by their characters. Windows of WINDOW words overlap
by half; in each, a recurrent network runs in either direction, attention pools the states, and a text's score is that of its worst window.

Labels are learnt from a bounded sample: at most SAMPLE rows of each class, those with the smallest hashes, and at most
WINDOWS windows of each, evenly spread; classes are weighed back to their share in all labelled rows. A text counts by its worst window in
training, too. Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirspark.llm.common import documents, settle, table, text_of

#: Rows of each class and windows of each row that training sees at most.
SAMPLE, WINDOWS = 1500, 24
WINDOW, STRIDE = 64, 32
STATE, INPUT, ATTENTION = 16, 16, 16
WORD_ROWS, GRAM_ROWS = 1 << 15, 1 << 16
GRAMS = range(3, 6)
ROUNDS, BATCH, RATE, SEED = 6, 64, 0.005, 7
THRESHOLD = 0.3
#: Inputs of words that a Python worker remembers, and windows that it runs at once.
REMEMBERED, TOGETHER = 250_000, 256
WORD = re.compile(r"\w+")
STEP = np.uint64(0x9E3779B97F4A7C15)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def grams(words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each length, the rows of all words' character n-grams in the words' order, and the words that they belong to."""
    marked = ["^" + w + "$" for w in words]
    text = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    sizes = np.array([len(w) for w in marked])
    of = np.repeat(np.arange(len(marked)), sizes)
    left = np.cumsum(sizes)[of] - np.arange(len(text))  # characters from here to the word's end
    hashed, rows, owners = np.zeros(len(text), dtype=np.uint64), [], []
    for n in range(1, max(GRAMS) + 1):
        hashed = hashed[: len(text) - n + 1] * STEP + text[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(left[: len(hashed)] >= n)
            x = hashed[at] + np.uint64(n)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            rows.append(((x ^ (x >> np.uint64(32))) % np.uint64(GRAM_ROWS)).astype(np.int64))
            owners.append(of[at])
    return rows, owners


def grams_by_word(words: list[str], together: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """The rows of each word's n-grams, word after word, and where each word's begin, and the end."""
    found, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for a in range(0, len(words), together):
        rows, owners = grams(words[a : a + together])
        rows, owners = np.concatenate(rows), np.concatenate(owners)
        found.append(rows[np.argsort(owners, kind="stable")].astype(np.int32))
        counts.append(np.bincount(owners, minlength=len(words[a : a + together])))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)


def word_rows(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % WORD_ROWS for w in words], dtype=np.int64)


@dataclass
class Network:
    """The parameters; sides are forward and backward, gates reset, update and candidate."""

    words: np.ndarray
    grams: np.ndarray
    inputs: np.ndarray  # INPUT x (2 sides x 3 gates x STATE)
    bias: np.ndarray
    states: np.ndarray  # 2 sides x STATE x (3 gates x STATE)
    attend: np.ndarray  # 2 STATE x ATTENTION
    point: np.ndarray
    out: np.ndarray
    shift: np.ndarray

    @classmethod
    def new(cls, seed: int, prior: float) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else shape[0])).astype(np.float32)
        words, grams_ = (0.1 * rng.standard_normal((n, INPUT)).astype(np.float32) for n in (WORD_ROWS, GRAM_ROWS))
        return cls(words, grams_, draw(INPUT, 6 * STATE), np.zeros(6 * STATE, np.float32), draw(2, STATE, 3 * STATE), draw(2 * STATE, ATTENTION), draw(ATTENTION), draw(2 * STATE), np.array([np.log(prior / (1 - prior))], np.float32))

    def word_inputs(self, words: list[str]) -> np.ndarray:
        sums, n = np.zeros((len(words), INPUT), np.float32), np.zeros(len(words))
        for rows, owners in zip(*grams(words), strict=True) if words else ():
            begin = np.flatnonzero(np.diff(owners, prepend=-1))
            if len(begin):
                sums[owners[begin]] += np.add.reduceat(self.grams[rows], begin, axis=0)
                n += np.bincount(owners, minlength=len(words))
        return self.words[word_rows(words)] + sums / n[:, None]

    def gates(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.inputs + self.bias).astype(np.float32)

    def run(self, gates: np.ndarray, words: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """The log odds of each window from rows of gates (6 STATE wide), by (windows, words) and which words exist; with keep, what the way back needs.

        Both sides take their steps together: step t is word t for the one, and word t from the end for the other.
        """
        n, size = words.shape
        live = np.ascontiguousarray(mask.T)
        x = np.empty((size, 2, 3 * STATE, n), np.float32)  # windows last, so that gates are whole blocks of memory
        told = gates[words.T].transpose(0, 2, 1)
        x[:, 0], x[:, 1] = told[:, : 3 * STATE], told[::-1, 3 * STATE :]
        alive = np.stack([live, live[::-1]], axis=1)[:, :, None]
        turned = np.ascontiguousarray(self.states.transpose(0, 2, 1))
        h, h_all, steps = np.zeros((2, STATE, n), np.float32), np.empty((size, 2, STATE, n), np.float32), []
        for t in range(size):
            hu = np.matmul(turned, h)
            g = x[t, :, : 2 * STATE]
            g += hu[:, : 2 * STATE]
            g *= 0.5
            np.tanh(g, out=g)  # a sigmoid is half of one plus a tanh of the half
            g += 1
            g *= 0.5
            new = g[:, :STATE] * hu[:, 2 * STATE :]
            new += x[t, :, 2 * STATE :]
            np.tanh(new, out=new)
            if keep:
                steps.append((h, g[:, :STATE], g[:, STATE:], new, hu[:, 2 * STATE :]))
            change = 1 - g[:, STATE:]
            change *= new - h
            change *= alive[t]
            h = np.add(h, change, out=h_all[t])
        both = np.concatenate([h_all[:, 0], h_all[::-1, 1]], axis=1)
        seen = np.tanh(np.matmul(self.attend.T, both))
        e = np.where(live > 0, np.matmul(self.point, seen), np.float32(-1e9))
        e = np.exp(e - e.max(axis=0)) * live
        weight = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = (weight[:, None] * both).sum(axis=0)
        return self.out @ pooled + self.shift[0], {"h": both, "seen": seen, "weight": weight, "pooled": pooled, "steps": steps, "alive": alive} if keep else {}

    def back(self, told: dict, d: np.ndarray) -> tuple[np.ndarray, dict]:
        """The gradients of the gates' inputs, (words, windows, 6 STATE), and of the parameters behind them, from those of the log odds."""
        both, seen, weight, alive = told["h"], told["seen"], told["weight"], told["alive"]
        size, _, n = both.shape
        grad = {"out": told["pooled"] @ d, "shift": d.sum(keepdims=True)}
        d_pooled = self.out[:, None] * d
        d_weight = (both * d_pooled).sum(axis=1)
        d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_seen = d_e[:, None] * self.point[:, None] * (1 - seen**2)
        grad["point"] = (d_e[:, None] * seen).sum(axis=(0, 2))
        grad["attend"] = np.matmul(both, d_seen.transpose(0, 2, 1)).sum(axis=0)
        d_both = weight[:, None] * d_pooled + np.matmul(self.attend, d_seen)
        d_out = np.stack([d_both[:, :STATE], d_both[::-1, STATE:]], axis=1)
        d_gates, d_h = np.empty((size, 2, 3 * STATE, n), np.float32), np.zeros((2, STATE, n), np.float32)
        grad["states"] = np.zeros_like(self.states)
        for t in range(size - 1, -1, -1):
            h, reset, keep, new, hn = told["steps"][t]
            d_h = d_h + d_out[t]
            moved = d_h * alive[t]
            d_new = moved * (1 - keep) * (1 - new**2)
            d_keep = moved * (h - new) * keep * (1 - keep)
            d_reset = d_new * hn * reset * (1 - reset)
            d_gates[t] = np.concatenate([d_reset, d_keep, d_new], axis=1)
            d_hu = np.concatenate([d_reset, d_keep, d_new * reset], axis=1)
            grad["states"] += np.matmul(h, d_hu.transpose(0, 2, 1))
            d_h = d_h - moved * (1 - keep) + np.matmul(self.states, d_hu)
        return np.concatenate([d_gates[:, 0], d_gates[::-1, 1]], axis=1).transpose(0, 2, 1), grad


def summed(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """The sum of the rows of each group, 0 to n - 1."""
    return np.stack([np.bincount(groups, weights=values[:, k], minlength=n) for k in range(values.shape[1])], axis=1).astype(np.float32)


class Adam:
    """Steps for whole parameters and for single rows of the tables."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {f.name: np.zeros_like(getattr(net, f.name)) for f in fields(net)}
        self.v = {f.name: np.zeros_like(getattr(net, f.name)) for f in fields(net)}

    def step(self, grads: dict, rows: dict) -> None:
        self.t += 1
        for name, g in grads.items():
            at = rows.get(name, slice(None))
            m, v = self.m[name], self.v[name]
            m[at] = 0.9 * m[at] + 0.1 * g
            v[at] = 0.999 * v[at] + 0.001 * g**2
            p = getattr(self.net, name)
            p[at] -= self.rate * (m[at] / (1 - 0.9**self.t)) / (np.sqrt(v[at] / (1 - 0.999**self.t)) + 1e-8)


def windows_of(size: int) -> list[int]:
    """Where the windows of a text of size words begin; the last one reaches the end. At least one, which may be empty."""
    return [*range(0, max(1, size - WINDOW + 1), STRIDE)] + ([size - WINDOW] if size > WINDOW and (size - WINDOW) % STRIDE else [])


def train(texts: list[list[list[str]]], labels: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS, seed: int = SEED) -> Network:
    """A network from texts, each a list of windows of words, with labels and weights. The same input gives the same network."""
    net = Network.new(seed, float(np.clip((labels * weights).sum() / weights.sum(), 0.01, 0.99)))
    vocabulary = sorted({w for windows in texts for x in windows for w in x})
    number = {w: i + 1 for i, w in enumerate(vocabulary)}
    gram_rows, gram_begin = grams_by_word(vocabulary)
    own_rows = word_rows(vocabulary)
    of = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    words, mask = np.zeros((len(of), WINDOW), np.int32), np.zeros((len(of), WINDOW), np.float32)
    for i, x in enumerate(w for windows in texts for w in windows):
        words[i, : len(x)], mask[i, : len(x)] = [number[w] for w in x], 1
    first = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    adam, rng = Adam(net, RATE), np.random.default_rng(seed)

    for turn in range(rounds):
        inputs = np.zeros((len(vocabulary) + 1, 6 * STATE), np.float32)
        for a in range(0, len(vocabulary), 4096):
            inputs[a + 1 : a + 4097] = net.gates(net.word_inputs(vocabulary[a : a + 4096]))
        scores = np.concatenate([net.run(inputs, words[a : a + TOGETHER], mask[a : a + TOGETHER])[0] for a in range(0, len(of), TOGETHER)])
        del inputs
        worst = np.array([a + np.argmax(scores[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)])
        any_one = first[:-1] + (rng.random(len(texts)) * np.diff(first)).astype(np.int64)
        # a clean text's windows are all clean; of a toxic one only the worst is known to be, but at first no worst one is known
        picked = np.concatenate([worst, any_one[labels == 0] if turn else any_one])
        owner = of[picked]
        order = rng.permutation(len(picked))
        for a in range(0, len(order), BATCH):
            at = order[a : a + BATCH]
            used, inverse = np.unique(words[picked[at]], return_inverse=True)
            local = used[used > 0] - 1
            rows, sizes = gram_rows[spread(gram_begin[local], gram_begin[local + 1] - gram_begin[local])], gram_begin[local + 1] - gram_begin[local]
            x = np.zeros((len(used), INPUT), np.float32)
            begin = np.cumsum(sizes) - sizes
            if len(local):
                x[used > 0] = net.words[own_rows[local]] + np.add.reduceat(net.grams[rows], begin, axis=0) / sizes[:, None]
            inverse = inverse.reshape(len(at), WINDOW)
            odds, told = net.run(net.gates(x), inverse, mask[picked[at]], keep=True)
            d = ((sigmoid(odds) - labels[owner[at]]) * weights[owner[at]] / weights.mean() / len(at)).astype(np.float32)
            d_gates, grads = net.back(told, d)
            by_word = summed(d_gates.reshape(-1, 6 * STATE), inverse.T.ravel(), len(used))
            grads |= {"inputs": x.T @ by_word, "bias": by_word.sum(axis=0)}
            d_x = (by_word @ net.inputs.T)[used > 0]
            rows_of = {}
            for name, at_rows, each in (("words", own_rows[local], d_x), ("grams", rows, np.repeat(d_x / sizes[:, None], sizes, axis=0))):
                which, where = np.unique(at_rows, return_inverse=True)
                grads[name], rows_of[name] = summed(each, where, len(which)), which
            norm = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
            adam.step({k: g / max(1.0, norm) for k, g in grads.items()}, rows_of)
    return net


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Scorer:
    """Scores whole texts by all their windows; the inputs of words are remembered, up to a bound."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {"": 0}
        self.gates, self.size = np.zeros((1024, 6 * STATE), np.float32), 1

    def learn(self, new: list[str]) -> None:
        if self.size + len(new) > len(self.gates):
            more = np.zeros((max(2 * len(self.gates), self.size + len(new)), 6 * STATE), np.float32)
            more[: self.size] = self.gates[: self.size]
            self.gates = more
        for a in range(0, len(new), 4096):
            self.gates[self.size : self.size + len(new[a : a + 4096])] = self.net.gates(self.net.word_inputs(new[a : a + 4096]))
            self.number.update(zip(new[a : a + 4096], range(self.size, self.size + 4096), strict=False))
            self.size += len(new[a : a + 4096])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.size > REMEMBERED:
            self.forget()
        parts = [WORD.findall((x or "").lower()) for x in texts]
        if new := list(set().union(*parts) - self.number.keys()):
            self.learn(new)
        number = self.number
        ids = np.array([number[w] for x in parts for w in x], dtype=np.int64)
        sizes = np.array([len(x) for x in parts], dtype=np.int64)
        starts = [np.array(windows_of(n)) for n in sizes.tolist()]
        of = np.repeat(np.arange(len(parts)), [len(x) for x in starts])
        at = np.concatenate(starts)
        lengths = np.minimum(WINDOW, sizes[of] - at)
        at = at + (np.cumsum(sizes) - sizes)[of]
        odds = np.empty(len(of), np.float32)
        order = np.argsort(lengths, kind="stable")  # short windows together, so that padding costs little
        for a in range(0, len(order), TOGETHER):
            some = order[a : a + TOGETHER]
            width = max(1, int(lengths[some].max()))
            mask = np.arange(width) < lengths[some, None]
            places = np.where(mask, at[some, None] + np.arange(width), 0)
            words = np.where(mask, ids[places], 0) if len(ids) else np.zeros(mask.shape, np.int64)
            odds[some] = self.net.run(self.gates, words, mask.astype(np.float32))[0]
        return sigmoid(np.maximum.reduceat(odds, np.cumsum([0, *(len(x) for x in starts[:-1])])).astype(np.float64))


def sampled(docs: DataFrame, labels: DataFrame, sample: int) -> tuple[list[list[list[str]]], np.ndarray, np.ndarray]:
    """Windows, labels and weights of the rows that training sees. At most sample rows of a class, WINDOWS windows of WINDOW words each."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(F.col("doc_id")))
    classes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = known.where("false")
    for y in sorted(classes):
        picked = picked.unionByName(known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    picked = settle(picked)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = []
            for text in batch.column(2):
                words = WORD.findall((text.as_py() or "").lower())
                starts = windows_of(len(words))
                starts = [starts[i * len(starts) // WINDOWS] for i in range(WINDOWS)] if len(starts) > WINDOWS else starts
                told.append([" ".join(words[a : a + WINDOW]) for a in starts])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(told, pa.list_(pa.string()))], ["doc_id", "toxic", "windows"])

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"), "text")
    rows = sorted(rows.mapInArrow(cut, "doc_id long, toxic long, windows array<string>").orderBy(F.xxhash64("doc_id"), "doc_id", "windows").limit(len(classes) * sample).collect(), key=lambda r: (r.doc_id, r.windows))
    y = np.array([r.toxic for r in rows], dtype=np.float32)
    total = sum(classes.values())
    share = {int(k): (n / total) / max(1, int((y == k).sum())) for k, n in classes.items()}
    one: dict[str, str] = {}
    return [[[one.setdefault(x, x) for x in w.split(" ")] if w else [] for w in r.windows] for r in rows], y, np.array([share[int(v)] * len(rows) for v in y], dtype=np.float32)


def held_out(doc_id: Column) -> Column:
    """Rows that labels aren't learnt from. A null id is none of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_rows(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of docs.

    Null and empty texts get the score of an empty window. Null and repeated ids get rows of their own. No columns but doc_id and text are read.
    """
    held = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(scorer.scores(part.column(2).to_pylist()))], ["doc_id", "held_out", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), text_of().alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


_SCORERS: dict = {}


def scorer_of(held) -> Scorer:
    """One for each network and Python worker."""
    if _SCORERS.get("net") is not held.value:
        _SCORERS.update(net=held.value, scorer=Scorer(held.value))
    return _SCORERS["scorer"]


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """score_rows with a network learnt from labels. Without labelled rows the score is a network's that has learnt nothing; of differing labels of one id the larger counts."""
    texts, y, weights = sampled(docs, labels, sample)
    return score_rows(docs, train(texts, y, weights) if len(y) else Network.new(SEED, 0.1))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
