"""BPE encoding and decoding as streaming transducers.

A byte-level BPE file gives bytes for tokens and ranks for merges. Encoding is left to right: for each
byte position the last token of the encoding of everything before it is unique, and a token may
follow another exactly if no merge crosses the border between them. So one token is kept for each
position, and all positions that later text can still build on lie within the longest token of the
end. How many bytes behind a border can decide on it follows from the merge list (sufficient_lookahead): tokens are
emitted as soon as so many bytes behind them are known, and no more than about twice as many are held.

Text comes in chunks of any size. Splitting into words needs a few characters of lookahead, and
a word of any length is fed to the transducer in parts, so memory doesn't grow with the text.
Decoding maps tokens to bytes and runs them through an incremental UTF-8 machine.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from dirspark.llm.common import documents

FILE = "byte_bpe_50k.json"
#: The split of text into words that the file's byte-level pre-tokenizer stands for.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A word is certain once so many characters after it are known.
WORD_LOOKAHEAD = 3
#: Below this code point the regular expressions and the tokenizer agree on every character's class.
AGREED = 0x530
RUNS = {"letter": regex.compile(r"\p{L}*"), "number": regex.compile(r"\p{N}*"), "other": regex.compile(r"[^\s\p{L}\p{N}]*"), "space": regex.compile(r"\s*")}
#: Stand-ins for characters of each class, in an agreed block.
STAND_IN = {"letter": ord("é"), "number": ord("²"), "other": ord("±"), "space": 0xA0}
LONG_WORD = 1 << 14
#: Blanks that the white space around them may claim.
AMONG_SPACES = re.compile(r"\s (?:\s|\Z)")


def tokenizer_path(name: str = FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Byte-level files write bytes as printable characters: these stand for themselves, the rest for 256 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Classes(dict):
    """For str.translate: characters whose class the tokenizer must be asked for become stand-ins."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, c: int) -> int:
        if c < AGREED:
            self[c] = c
        else:
            kinds = {"letter": "a", "number": "1", "other": "!"}
            kind = next((k for k, x in kinds.items() if len(self.split(x + chr(c))) == 1), "space")
            self[c] = STAND_IN[kind]
        return self[c]


class Merges:
    """A merge list with what the transducer needs of it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        alphabet, model = byte_alphabet(), told["model"]
        as_bytes = {s: bytes(alphabet[c] for c in s) for s in model["vocab"]}
        self.id_of = {as_bytes[s]: i for s, i in model["vocab"].items()}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.special = {x["content"]: x["id"] for x in told["added_tokens"] if x["special"]}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank_of = {(self.id_of[as_bytes[a]], self.id_of[as_bytes[b]]): r for r, (a, b) in enumerate(merges)}
        made = {self.id_of[as_bytes[a] + as_bytes[b]]: (self.id_of[as_bytes[a]], self.id_of[as_bytes[b]], r) for r, (a, b) in reversed(list(enumerate(merges)))}
        self.longest = max(map(len, self.id_of))
        self.right_edge, self.left_edge = ({t: self._edge(made, t, side) for t in self.id_of.values()} for side in (1, 0))
        self.follows: dict[int, bool] = {}
        self.classes = Classes(path)
        self.odd = re.compile(f"[^\\x00-{chr(AGREED - 1)}]")
        self.in_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.special_length = max(map(len, self.special), default=1)

    @staticmethod
    def _edge(made: dict, token: int, side: int) -> tuple[tuple[int, float], ...]:
        """The tokens that lie at this side of token while it is built, each with the rank that ends it."""
        out, ends = [], float("inf")
        while True:
            out.append((token, ends))
            if token not in made:
                return tuple(out)
            ends, token = made[token][2], made[token][side]

    @lru_cache(maxsize=1)  # noqa: B019
    def token_bytes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens' bytes in a row, and each id's first place and size there; one more id, without bytes, stands for unknown ones."""
        parts = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 2)]
        size = np.array([len(x) for x in parts], dtype=np.int64)
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(size) - size, size

    def may_follow(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border of a and b. Of equal merges the left one goes first."""
        key = a << 20 | b
        if (known := self.follows.get(key)) is None:
            rank = self.rank_of.get
            known = not any((r := rank((x, y))) is not None and r < ends_x and r <= ends_y for x, ends_x in self.right_edge[a] for y, ends_y in self.left_edge[b])
            if len(self.follows) > 500_000:
                self.follows.clear()
            self.follows[key] = known
        return known

    @lru_cache(maxsize=1)  # noqa: B019
    def sufficient_lookahead(self) -> int:
        """Bytes after a border that can decide on it.

        A merge at the border (x, y) may be forestalled by a better-ranked one (y, z), that by a still
        better one at z's end, and so on: ranks fall along such a chain, so it ends. The longest chain in
        bytes is found in the order of ranks; to it comes the token that ends at the border.
        """
        by_left: dict[int, tuple[list[int], list[int]]] = {}
        most = 0
        for (a, b), r in sorted(self.rank_of.items(), key=lambda x: x[1]):
            further = 0
            for x, ends in self.right_edge[b]:
                ranks, best = by_left.get(x, ((), ()))
                if k := bisect.bisect_left(ranks, min(ends, r)):
                    further = max(further, best[k - 1])
            size = len(self.bytes_of[b]) + further
            ranks, best = by_left.setdefault(a, ([], []))
            ranks.append(r)
            best.append(max(size, best[-1] if best else 0))
            most = max(most, size)
        return most + self.longest


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


@lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One for each Python worker, so that what it remembers serves all its tasks."""
    return Encoder(merges_of(path))


class WordTransducer:
    """Encodes one word, fed in parts; the ids that became stable come back at once."""

    def __init__(self, merges: Merges):
        self.m, self.held, self.token = merges, b"", [-1]
        self.lookahead = merges.sufficient_lookahead()
        self.check_at = 2 * self.lookahead

    def feed(self, part: bytes) -> list[int]:
        m, held, token = self.m, self.held + part, self.token
        id_of, longest, may_follow = m.id_of, m.longest, m.may_follow
        for end in range(len(self.held) + 1, len(held) + 1):
            for start in range(max(0, end - longest), end):
                t = id_of.get(held[start:end])
                if t is not None and (token[start] < 0 or may_follow(token[start], t)):
                    token.append(t)
                    break
        self.held = held
        if len(held) < self.check_at:
            return []
        return self._emit()

    def _chain(self, end: int) -> list[int]:
        """Borders of the encoding of the first end bytes held, from the right."""
        out = [end]
        while end > 0:
            end -= len(self.m.bytes_of[self.token[end]])
            out.append(end)
        return out

    def _emit(self) -> list[int]:
        """Ids before the last border that has the sufficient lookahead behind it: no later byte can change them."""
        n = len(self.held)
        border = next(end for end in self._chain(n) if end <= n - self.lookahead)
        out = self._ids(border)
        # What comes next may merge across no border that is kept, so the token before it stays known.
        last = self.token[border]
        self.held, self.token = self.held[border:], [last if border else self.token[0], *self.token[border + 1 :]]
        self.check_at = len(self.held) + self.lookahead
        return out

    def _ids(self, end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(self.token[end])
            end -= len(self.m.bytes_of[out[-1]])
        return out[::-1]

    def finish(self) -> list[int]:
        out = self._ids(len(self.held))
        self.held, self.token = b"", [-1]
        return out


class Memo(dict):
    """A dict that makes what it lacks and keeps two generations of so many entries."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        if (out := self.old.get(key)) is None:
            out = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out


class Encoder:
    """Encodes a text that comes in chunks; feed() and finish() return ids as little-endian 32-bit integers.

    What comes before a blank never depends on what follows it, unless it stands among other white space; so texts are
    cut there, and the encodings of such stretches and of words are remembered.
    """

    REMEMBERED = 450_000
    #: Longer words and stretches aren't remembered.
    SHORT = 64

    def __init__(self, merges: Merges):
        self.m, self.lookahead = merges, merges.sufficient_lookahead()
        self.word_ids = Memo(self.encode_word, self.REMEMBERED // 4)
        self.stretches = Memo(self._stretch_ids, self.REMEMBERED)
        self.reset()

    def reset(self) -> None:
        self.text, self.open, self.kind = "", None, ""

    def encode_word(self, word: str) -> bytes:
        """A word longer than the lookahead streams; before the end of a shorter one nothing is certain, so it is taken whole."""
        data = word.encode()
        if len(data) > self.lookahead:
            t = WordTransducer(self.m)
            return self._ids(t.feed(data) + t.finish())
        id_of, bytes_of, may_follow, longest = self.m.id_of, self.m.bytes_of, self.m.may_follow, self.m.longest
        out, at, n, dead = [], 0, len(data), set()
        size = min(n, longest)
        while at < n:  # the longest token that may follow; a place from which none does is never come to again
            while size:
                t = id_of.get(data[at : at + size])
                if t is not None and at + size not in dead and (not out or may_follow(out[-1], t)):
                    break
                size -= 1
            if size:
                out.append(t)
                at += size
                size = min(n - at, longest)
            else:
                dead.add(at)
                back = len(bytes_of[out.pop()])
                at, size = at - back, back - 1
        return self._ids(out)

    def spans(self, text: str) -> list[str]:
        if text.isascii() or not self.m.odd.search(text):
            return WORDS.findall(text)
        return [text[x.start() : x.end()] for x in WORDS.finditer(text.translate(self.m.classes))]

    def _stretch_ids(self, text: str) -> bytes:
        """Most stretches are one word: a blank and letters."""
        if (text[1:] if text[:1] == " " else text).isalpha() and (text.isascii() or not self.m.odd.search(text)):
            return self.encode_word(text)
        return self.words(self.spans(text))

    def words(self, words: list[str]) -> bytes:
        ids, short = self.word_ids, self.SHORT
        return b"".join([ids[w] if len(w) <= short else self.encode_word(w) for w in words])

    def whole(self, text: str) -> bytes:
        """All ids of a text without special tokens."""
        if "\0" in text or AMONG_SPACES.search(text):
            return self.words(self.spans(text))
        ids, short = self.stretches, self.SHORT
        return b"".join([ids[t] if len(t) <= short else self.words(self.spans(t)) for t in text.replace(" ", "\0 ").split("\0")])

    def feed(self, chunk: str) -> bytes:
        self.text += chunk
        out = []
        while hit := self.m.in_special.search(self.text):
            before, after = self.text[: hit.start()], self.text[hit.end() :]
            out += [self._stretch(before, True), np.array([self.m.special[hit[0]]], dtype="<u4").tobytes()]
            self.text = after
        # The end may be the start of a special token.
        keep = self.m.special_length - 1
        text, rest = (self.text[:-keep], self.text[-keep:]) if keep else (self.text, "")
        out.append(self._stretch(text, False))
        self.text = self.pending + rest
        return b"".join(out)

    def finish(self) -> bytes:
        out = self._stretch(self.text, True)
        self.reset()
        return out

    def _stretch(self, text: str, last: bool) -> bytes:
        """Encodes what is certain of text; the rest is left in pending. last: nothing follows in this stretch."""
        out = []
        self.pending = ""
        if self.open:
            seen = text.translate(self.m.classes)
            end = RUNS[self.kind].match(seen).end()
            if self.kind == "space":  # the last space goes with what follows, unless nothing does
                end = end if end == len(text) and last else max(0, end - 1)
            out.append(self._ids(self.open.feed(text[:end].encode())))
            more = len(text) - end <= (self.kind == "space")
            if more and not last:
                self.pending = text[end:]
                return b"".join(out)
            out.append(self._ids(self.open.finish()))
            self.open, text = None, text[end:]
        words = self.spans(text)
        if not last:
            size, k = 0, len(words)
            while k and size <= WORD_LOOKAHEAD:
                k -= 1
                size += len(words[k])
            # words[k] is followed by too little, as are all after it
            self.pending = "".join(words[k:])
            tail = words[k] if k < len(words) else ""
            words = words[:k]
            if len(tail) > LONG_WORD:
                out.append(self.words(words))
                self._begin(tail)
                return b"".join([*out, self._ids(self.open.feed(self.head.encode()))])
        out.append(self.words(words))
        return b"".join(out)

    def _begin(self, word: str) -> None:
        """Opens a long word: all of it is fed but the last characters, which stay pending."""
        seen = word.translate(self.m.classes)
        self.kind = next(k for k, run in RUNS.items() if run.match(seen[1:2]).end())
        self.open, keep = WordTransducer(self.m), WORD_LOOKAHEAD + 1
        rest = self.pending[len(word) :]
        self.head, self.pending = word[:-keep], word[-keep:] + rest

    @staticmethod
    def _ids(ids: list[int]) -> bytes:
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str | None, chunk: int = 1 << 16) -> bytes:
        """All ids of a text. Null and the empty text have none."""
        text = text or ""
        if len(text) <= chunk and not self.m.in_special.search(text):
            return self.whole(text)
        parts = [self.feed(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        return b"".join([*parts, self.finish()])


class Decoder:
    """Ids to text, in parts of any size: bytes of tokens through an incremental UTF-8 machine.

    Bytes that aren't UTF-8 become U+FFFD, one for each maximal part of a sequence. Ids that the file lacks are left out.
    """

    def __init__(self, merges: Merges):
        self.table, self.first, self.size = merges.token_bytes()
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        ids = np.minimum(np.asarray(ids, dtype=np.int64), len(self.size) - 1)
        size = self.size[ids]
        ends = np.cumsum(size)
        place = np.repeat(self.first[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        return self.machine.decode(self.table[place].tobytes())

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)

    def decode(self, ids: bytes, step: int = 1 << 16) -> Iterator[str]:
        numbers = np.frombuffer(ids, dtype="<u4")
        for i in range(0, len(numbers), step):
            yield self.feed(numbers[i : i + step])
        yield self.finish()


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text of each row.

    Null and empty texts have no ids and decode to the empty text. Row for row: repeated and null doc_ids
    stay as they are, other columns aren't read. No shuffle.
    """
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, encoder = merges_of(path), encoder_of(path)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids, seen = encoder.encode(text), hashlib.sha256()
                for part in Decoder(merges).decode(ids):
                    seen.update(part.encode())
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(seen.hexdigest())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_rows(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian 32-bit integers) and text, decoded from the ids."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, encoder = merges_of(path), encoder_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encoder.encode(t) for t in part.column(3).to_pylist()]
                texts = ["".join(Decoder(merges).decode(x)) for x in ids]
                yield pa.record_batch([*part.columns[:3], pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], ["doc_id", "lang", "source", "n_tokens", "ids", "text"])

    return docs.select("doc_id", "lang", "source", "text").mapInArrow(run, "doc_id long, lang string, source string, n_tokens long, ids binary, text string")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    return digests(documents(spark, sf_dir))
