import json
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from dirspark.llm import audio, mixing, quality, tokencounts, toolcalls, warc
from dirspark.llm.common import shared_dir


# mixing
def test_mix_meets_its_targets_and_repeats(docs):
    rows = mixing.plan_mix(docs, ["doc_id", "source"]).collect()
    again = mixing.plan_mix(docs.repartition(7), ["doc_id", "source"]).collect()
    assert Counter(map(str, rows)) == Counter(map(str, again)) and len(rows) == docs.count()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    total = sum(r.size for r in rows)
    assert abs(sum(target.values()) - total) < 1e-6 * total
    for s in taken:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-9
    names = sorted((s for s in target if s is not None)) + [None] * (None in target)
    size = {r.source: r.source_size for r in rows}
    free = [s for s in names if target[s] < 3 * size[s]]
    levels = {target[s] / (names.index(s) % 3 + 1) for s in free}
    assert max(levels) - min(levels) < 1e-6 * max(levels)


def test_mix_of_nothing(no_docs):
    assert mixing.plan_mix(no_docs, ["doc_id"]).count() == 0 and mixing.mix(no_docs).count() == 0


# quality
def brute_statistics(t):
    import re

    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i : i + 8])].append(i)
    hit = {j for v in seen.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit)


def test_base_statistics(docs, spark):
    odd = ["a b c d e f g h " * 5, "x\n\nx\n x\nx", "#$ %&| <>\x0b\x0c\r*", "one " * 9, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    for df in (docs, more):
        got = quality.base_statistics(df.select("doc_id", "text"), ["doc_id"]).collect()
        want = Counter((r.doc_id, *brute_statistics(r.text)) for r in df.collect())
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want


def test_quality_rejects_outliers_only(spark):
    rng = random.Random(1)
    clean = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(1000)) for _ in range(rng.randrange(60, 900))), "en", "a") for i in range(120)]
    junk = [(500 + i, " ".join("word%d$$$" % rng.randrange(1000) for _ in range(200)), "en", "a") for i in range(10)]
    rows = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(clean + junk, "doc_id long, text string, lang string, source string"), ["doc_id"]).collect()}
    assert all(rows[i] for i in range(120)) and not any(rows[500 + i] for i in range(10))


def test_quality_edges(docs, no_docs):
    rows = quality.quality(docs, ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(r.kept is not None and r.base_failed is not None for r in rows)
    assert quality.quality(no_docs, ["doc_id"]).count() == 0


# token counts
def test_rollup_is_idempotent_and_additive(spark, docs, no_docs):
    r = tokencounts.Rollup(spark, f"{shared_dir(spark)}/counts")
    words = tokencounts.word_tokens()
    assert r.totals().count() == 0
    assert r.apply("a", tokencounts.inserted(docs, "w", words)) and not r.apply("a", tokencounts.inserted(docs, "w", words))
    want = Counter()
    for x in docs.collect():
        want[(x.source, x.lang, "n")] += 1
        want[(x.source, x.lang, "t")] += brute_statistics(x.text)[0]
    state = {(x.source, x.lang): (x.n_docs, x.n_tokens) for x in r.totals().collect()}
    assert state == {(s, g): (want[(s, g, "n")], want[(s, g, "t")]) for s, g, k in want if k == "n"}
    assert r.apply("none", tokencounts.inserted(no_docs, "w", words)) and r.apply("b", tokencounts.revised(docs, "w", words, words + 2))
    assert all(x.n_tokens == state[(x.source, x.lang)][1] + 2 * x.n_docs for x in r.totals().collect())
    assert r.apply("c", tokencounts.deleted(docs, "w", words + 2)) and all(x.n_docs == x.n_tokens == 0 for x in r.totals().collect())


def test_two_writers_lose_nothing(spark, docs, monkeypatch):
    """Another writer commits between the reading of the totals and the claim: the second starts again from the new totals."""
    folder = f"{shared_dir(spark)}/counts"
    a, b = tokencounts.Rollup(spark, folder), tokencounts.Rollup(spark, folder)
    words, claim, n = tokencounts.word_tokens(), tokencounts.Rollup.claim, docs.count()

    def late(self, seq, content):
        if self is a and seq == 1:
            assert b.apply("other", tokencounts.inserted(docs, "w", words))
        return claim(self, seq, content)

    monkeypatch.setattr(tokencounts.Rollup, "claim", late)
    assert a.apply("mine", tokencounts.inserted(docs, "w", words)) and not b.apply("mine", tokencounts.inserted(docs, "w", words))
    assert sum(x.n_docs for x in a.totals().collect()) == 2 * n
    assert sorted((r.seq, r.batch_id) for r in a.committed().collect()) == [(1, "other"), (2, "mine")]


def test_null_counts_and_signs_are_nothing(spark):
    r = tokencounts.Rollup(spark, f"{shared_dir(spark)}/counts")
    rows = spark.createDataFrame([("a", "en", "w", 1, None), ("a", "en", "w", None, 5), ("a", "en", "w", 1, 7)], "source string, lang string, tokenizer string, sign int, n_tokens long")
    assert r.apply("x", rows) and [tuple(x) for x in r.totals().collect()] == [("a", "en", "w", 2, 7)]


def test_streamed_changes_are_committed_once(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, sign int, n_tokens long"
    spark.createDataFrame([("a", "en", "w", 1, 7), ("b", "en", "w", 1, 2)], schema).write.parquet(str(tmp_path / "in"))
    r = tokencounts.Rollup(spark, f"{shared_dir(spark)}/counts")
    for _ in range(2):
        stream = r.follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "s", str(tmp_path / f"checkpoint{_}"))
        stream.processAllAvailable()
        stream.stop()
    assert sorted(tuple(x) for x in r.totals().collect()) == [("a", "en", "w", 1, 7), ("b", "en", "w", 1, 2)]


def test_token_count_query(spark, tmp_path, docs):
    from tokenizers import Tokenizer

    labels = [(1, 1, 1), (5, 0, 0), (5, 0, 0), (8, 0, 0), (6, 0, 1), (None, 0, 1), (777, 0, 1), (7, None, None)]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    library, want = Tokenizer.from_file(tokencounts.tokenizer_path()), Counter()
    for r in docs.collect():
        sign = r.doc_id not in (1, 6)
        n = len(library.encode(r.text or "", add_special_tokens=False).ids) + (r.doc_id in (5, 8))
        for name, count in (("words-1", brute_statistics(r.text)[0]), ("bytes-1", len((r.text or "").encode())), ("byte_bpe_50k-1", n)):
            want[(r.source, r.lang, name, "docs")] += sign
            want[(r.source, r.lang, name, "tokens")] += sign * count
    got = tokencounts.op6_token_counts(spark, str(tmp_path)).collect()
    assert {(r.source, r.lang, r.tokenizer, k): v for r in got for k, v in (("docs", r.n_docs), ("tokens", r.n_tokens))} == want


# WARC
def brute_revisits(rows):
    out = []
    for rid, site, seq, kind, headers in rows:
        if kind != "revisit":
            continue
        old = [(s, i, h) for i, u, s, k, h in rows if k == "response" and u == site and u is not None and s is not None and seq is not None and s < seq]
        if not old:
            out.append((rid, None, "missing"))
            continue
        _, oid, h = max(old, key=lambda x: (x[0], x[1]))
        h, g = h or {}, headers or {}
        if h.get("etag") and g.get("etag"):
            v = "resolved" if h["etag"].removeprefix("W/") == g["etag"].removeprefix("W/") else "changed"
        elif h.get("last-modified") and g.get("last-modified"):
            v = "resolved" if h["last-modified"] == g["last-modified"] else "changed"
        else:
            v = "no_validator"
        out.append((rid, oid, v))
    return sorted(out)


def test_revisits(spark):
    rng, rows = random.Random(2), []
    for i in range(400):
        site = rng.choice(["a.example/x", "a.example/x", "a.example/x", "b.example", f"c{i % 20}.example/y?p=1", None])
        h = rng.choice([None, {}, {"etag": "1"}, {"etag": "W/1"}, {"etag": "2", "date": "d"}, {"last-modified": "m"}, {"last-modified": "n", "content-type": "t"}])
        rows.append((f"r{i:04}", site, rng.choice([None, *range(0, 90)] if i % 9 == 0 else list(range(90))), rng.choice(["response", "revisit"]), h))
    df = spark.createDataFrame(rows, "record_id string, url string, seq long, kind string, headers map<string,string>")
    for bucket in (7, 1024):
        got = sorted((r.record_id, r.original_id, r.verdict) for r in warc.resolve_revisits(df, bucket).collect())
        assert got == brute_revisits(rows)
    assert warc.resolve_revisits(df.where("false")).count() == 0


def test_warc_files_and_headers(spark):
    data = warc.write_record("a", "http://www.X.example:80/p/?utm_source=1&b=2&a=1#f", "2024", "response", "200 OK", {"ETag": "1", "Content-Type": "t"}, b"\r\n\r\nbody") + warc.write_record("b", "https://x.example/p?a=1&b=2", "2025", "revisit", "304 Not Modified", {"ETag": "1", "Date": "now", "Content-Type": "u"})
    rows = warc.parse_records(spark.createDataFrame([(bytearray(data),)], "content binary")).collect()
    assert [(r.record_id, r.type, bytes(r.payload)) for r in rows] == [("a", "response", b"\r\n\r\nbody"), ("b", "revisit", b"")]
    df = spark.createDataFrame([(r.record_id, r.url, int(r.date), r.type, r.headers) for r in rows], "record_id string, url string, seq long, kind string, headers map<string,string>")
    (out,) = warc.resolve_revisits(df).collect()
    assert (out.original_id, out.verdict, out.headers) == ("a", "resolved", {"etag": "1", "date": "now", "content-type": "t"})


# tool calls
def test_calls(spark):
    calls = [
        (1, "c", 3, "search", '{"query":"x","after":["$a"]}'), (1, "a", 5, "search", '{"query":"é","n":1}'), (1, "b", 1, "summarise", '{"words": 9, "after": ["$c"]}'), (1, "b", 2, "summarise", "{}"), (1, None, 4, "search", "nope"),
        (2, "p", 1, "search", '{"query":"$q"}'), (2, "q", 2, "search", '{"query":"$p"}'), (2, "r", 3, "other", "{}"), (None, "z", 1, "summarise", '{"words": 3}'), (1, "d", 9, None, None),
    ]
    results = [(1, "a", 6, "late"), (1, "a", 4, "too early"), (1, "a", 8, "later"), (2, "p", 9, None), (3, "c", 9, "elsewhere"), (1, "b", 7, "ok"), (1, None, 9, "x")]
    out = toolcalls.link_calls(spark.createDataFrame(calls, "conv_id long, call_id string, seq long, tool string, arguments string"), spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string"), toolcalls.SCHEMAS).collect()
    got = {(r.conv_id, r.call_id): r for r in out}
    assert len(out) == 9
    assert [got[(1, k)].level for k in "acb"] == [0, 1, 2] and got[(2, "p")].level == got[(2, "q")].level == -1
    assert got[(1, "a")].problem == "$.n: unknown" and got[(1, "a")].result == "late" and got[(1, None)].problem == "not JSON"
    assert got[(2, "r")].problem == "unknown tool" and got[(None, "z")].problem == "$.words: out of range" and got[(1, "b")].status == "linked"
    assert got[(1, "a")].position < got[(1, "c")].position < got[(1, "b")].position and got[(2, "p")].position == 2
    text = got[(1, "c")].json
    assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False) and '"status":"unanswered"' in text
    assert toolcalls.link_calls(spark.createDataFrame(calls, "conv_id long, call_id string, seq long, tool string, arguments string").where("false"), spark.createDataFrame(results, "conv_id long, call_id string, seq long, content string"), toolcalls.SCHEMAS).count() == 0


def test_long_turns_are_whole_arguments(spark):
    turns = [(1, 0, "user", "word " * 200 + "a"), (2, 0, "user", "word " * 200 + "b"), (1, 1, "assistant", "yes")]
    calls, results = toolcalls.conversation_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in toolcalls.link_calls(calls, results, toolcalls.SCHEMAS).collect()}
    assert all(json.loads(got[c].arguments) == json.loads(got[c].json)["arguments"] == {"query": t} for c, _, role, t in turns if role == "user")
    assert got[1].arguments != got[2].arguments and got[1].problem == "$.query: too long"


# audio
def sound(seed, n=4 * audio.RATE):
    rng = np.random.default_rng(seed)
    t = np.arange(n // 16) / audio.RATE
    return np.concatenate([np.sin(2 * math.pi * 220 * 2 ** (rng.integers(0, 24) / 12) * t) + np.sin(2 * math.pi * 220 * 2 ** (rng.integers(0, 24) / 12) * t) for _ in range(16)]).astype(np.float32)


def test_filters_equal_plain_sums():
    image = audio.chroma(sound(1))
    kind, c, h, w = audio.FILTERS[1]
    prints, shift = audio.fingerprint(image), 2 * (len(audio.FILTERS) - 2)
    for t in range(len(prints)):
        a, b = image[t + w // 2 : t + w, c : c + h].sum() + 1e-6, image[t : t + w // 2, c : c + h].sum() + 1e-6
        assert int(prints[t]) >> shift & 3 == audio.GRAY[int(np.digitize(np.log(a / b), audio.LEVELS))]


def test_recordings_align(spark):
    a, b = sound(1), sound(2)
    cut, noisy = a[8 * audio.HOP :], a + np.random.default_rng(3).normal(0, 0.02, len(a)).astype(np.float32)
    rows = [(50, a), (7, a), (8, b), (9, cut), (10, noisy), (11, []), (12, None), (13, sound(4)), (None, a)]
    df = spark.createDataFrame([(i, None if x is None else [float(v) for v in x]) for i, x in rows], "rec_id long, samples array<float>")
    got = {r.rec_id: r for r in audio.match_recordings(df, "rec_id % 50 = 0").collect()}
    assert len(got) == 9 and got[50].class_id == got[7].class_id == 7 and got[11].class_id is None and got[12].n_frames == 0
    assert got[9].best_query == 7 and got[9].best_offset == -8 and got[9].bit_errors == 0
    assert got[10].best_query == 7 and got[10].best_offset == 0 and got[8].best_query is None and got[13].n_matches == 0
    assert audio.match_recordings(df.where("false"), "rec_id % 50 = 0").count() == 0


def test_index_finds_what_brute_force_finds(spark):
    rng = np.random.default_rng(5)
    base = [sound(20 + k, audio.RATE) for k in range(6)]
    rows = [(i, base[i % 6] + rng.normal(0, 0.05 * (i % 4), audio.RATE).astype(np.float32)) for i in range(60)]
    prints = {i: audio.fingerprint(audio.chroma(x)) for i, x in rows}
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in rows], "rec_id long, samples array<float>")
    got = {r.rec_id: r.n_matches for r in audio.match_recordings(df, "rec_id % 50 = 0").collect()}
    want = {i: sum(q != i and (prints[q] != p).any() and aligned_at_any_offset(prints[q], p) for q in (0, 50)) for i, p in prints.items()}
    assert sum(want.values()) and sum(min(got[i], want[i]) for i in prints) >= 0.9 * sum(want.values()) and all(got[i] <= want[i] for i in prints)


def aligned_at_any_offset(a, b):
    for offset in range(-len(a), len(b) + 1):
        x, y = a[max(0, -offset) :], b[max(0, offset) :]
        n = min(len(x), len(y))
        if n >= audio.LEAST_FRAMES and np.bitwise_count(x[:n] ^ y[:n]).sum() <= audio.MOST_ERRORS * 32 * n:
            return True
    return False


def test_vector_recordings_align_with_their_hundred(spark):
    """Recall against all offsets, right offsets, and no strangers."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.normal(0, 0.1, 64)]) for i in range(300)] + [(300, None), (301, []), (None, [0.5] * 70)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    recordings = audio.vector_recordings(df)
    prints = {r.rec_id: np.frombuffer(r.prints, "<u4") for r in audio.prints_of(recordings).collect() if r.rec_id is not None and r.n_frames}
    got = {r.rec_id: r for r in audio.match_recordings(recordings, "rec_id % 50 = 0").collect()}
    want = {i: sum(aligned_at_any_offset(prints[q], p) for q in range(0, 300, 50) if q != i) for i, p in prints.items()}
    assert len(got) == 303 and len(prints) == 300 and sum(want.values()) >= 500
    assert sum(min(got[i].n_matches, want[i]) for i in prints) >= 0.9 * sum(want.values())
    right = [got[i].best_query // 100 == i // 100 and got[i].best_offset == 2 * (i % 5 - got[i].best_query % 5) for i in prints if got[i].best_query is not None]
    assert sum(right) >= 0.95 * len(right) and got[300].class_id is None and got[301].n_frames == 0


def brute_alignments(prints, queries):
    out = []
    for q in queries:
        for k in prints:
            offsets = Counter(j - i for i, x in enumerate(prints[q]) for j, y in enumerate(prints[k]) if x == y)
            if k == q or not offsets:
                continue
            offset = min(offsets, key=lambda o: (-offsets[o], o))
            both = [(int(prints[q][i]), int(prints[k][i + offset])) for i in range(len(prints[q])) if 0 <= i + offset < len(prints[k])]
            errors = sum((x ^ y).bit_count() for x, y in both)
            if len(both) >= audio.LEAST_FRAMES and errors <= audio.MOST_ERRORS * 32 * len(both):
                out.append((q, k, offset, len(both), errors))
    return sorted(out)


def common_prints():
    rng = np.random.default_rng(6)
    base, prints = rng.integers(0, 1 << 32, 12, dtype=np.uint32), {}
    for i in range(100):  # every other frame has a bit of its own changed: equal integers stand alone, each in 100 classes
        p = base.copy()
        p[1::2] ^= np.uint32(1) << rng.integers(0, 32, 6).astype(np.uint32)
        prints[i] = p[rng.integers(0, 3) :]
    prints |= {100 + i: rng.choice(base[:3], 9) for i in range(20)}  # many offsets
    return prints


@pytest.mark.parametrize("block", [1 << 21, 150])
def test_common_integers_are_kept(spark, monkeypatch, block):
    monkeypatch.setattr(audio, "BLOCK_FRAMES", block, raising=False)
    prints = common_prints()
    df = spark.createDataFrame([(i, p.tobytes()) for i, p in prints.items()], "class_id long, prints binary")
    got = sorted(map(tuple, audio.align(df.where("class_id % 10 = 0"), df).collect()))
    want = brute_alignments(prints, range(0, 120, 10))
    assert got == want and len(want) >= 900


@pytest.mark.parametrize("step", [1, 20, 3000])
def test_counting_in_steps(monkeypatch, step):
    monkeypatch.setattr(audio, "STEP_HITS", step)
    prints = common_prints()
    block = lambda ids: audio.Prints(list(ids), [prints[i].tobytes() for i in ids])
    got = sorted(tuple(r.values()) for batch in audio.confirmed(block(range(0, 120, 10)), block(prints)) for r in batch.to_pylist())
    assert got == brute_alignments(prints, range(0, 120, 10))


@pytest.mark.parametrize("value,schema,want", [(1, {"type": "integer"}, None), (True, {"type": "integer"}, "$: not integer"), ([1, "a"], {"type": "array", "items": {"type": "number"}}, "$[1]: not number"), ("b", {"enum": ["a"]}, "$: not in enum")])
def test_faults(value, schema, want):
    assert toolcalls.fault(value, schema) == want
