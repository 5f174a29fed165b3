"""Tool calls against a plain version: random graphs with circles, repeated identifiers, nulls, odd JSON."""

import json
import random

import pytest

from dirspark.llm import toolcalls

SCHEMA = {"t": {"type": "object", "properties": {"n": {"type": "integer", "minimum": 3}}}}
CALLS = "conv_id long, call_id string, seq long, tool string, arguments string, level string, node array<int>, conv_key double"
RESULTS = "conv_id long, call_id string, seq long, content string, position string"


def least(x):
    """Null first."""
    return (x is not None, x if x is not None else "")


def brute(calls, results):
    out = []
    for conv in {c[0] for c in calls}:
        named, rest = {}, []
        for _, call, seq, tool, arguments, *_ in sorted((c for c in calls if c[0] == conv), key=lambda c: ((c[2] is not None, c[2] or 0), least(c[3]), least(c[4]))):
            if call is None:
                rest.append((None, seq, tool, arguments))
            else:
                named.setdefault(call, (call, seq, tool, arguments))
        rows = [(*x, *toolcalls.parsed(x[3], SCHEMA.get(x[2]))) for x in [*named.values(), *rest]]
        needs = {x[0]: [n for n in x[6] if n in named] for x in rows if x[0] is not None}
        level = dict.fromkeys(needs, -1)
        for k in range(len(needs)):  # a call is placed as soon as all its needs are
            for x in [x for x in needs if level[x] < 0 and all(0 <= level[n] < k for n in needs[x])]:
                level[x] = k
        found = []
        for call, seq, tool, _, told, problem, _ in rows:
            answers = [(r[2], least(r[3]), r[3]) for r in results if r[0] == conv and r[1] == call and call is not None and r[2] is not None and seq is not None and r[2] > seq]
            at = level[call] if call is not None else 0
            status = "invalid" if problem else "circular" if at < 0 else "linked" if answers else "unanswered"
            found.append((conv, call, seq, tool, at, status, problem, told, min(answers)[2] if answers else None))
        found.sort(key=lambda x: (x[4] < 0, x[4], (x[2] is not None, x[2] or 0), least(x[1]), least(x[3])))
        out += [(*x[:5], i + 1, *x[5:]) for i, x in enumerate(found)]
    return sorted(out, key=repr)


def made(seed):
    rng, calls, results = random.Random(seed), [], []
    for conv in (None, -1, 1, 2, 3):
        n = 40 if conv == 1 else 9
        for i in range(n):
            need = [f"$k{rng.randrange(max(1, i)) if rng.random() < 0.97 else rng.randrange(n)}" for _ in range(rng.choice([0, 1, 1, 1, 2]))]
            if conv == 3:  # a chain
                need = [f"$k{i - 1}"]
            calls.append((conv, f"k{i}", rng.choice([None, *range(9)]), rng.choice(["t", "t", "t", "u", None]), json.dumps({"n": rng.randrange(9), "of": need}), "x", [1], 0.5))
            results += [(conv, f"k{rng.randrange(n)}", rng.choice([None, *range(12)]), rng.choice([None, "", "é\n\u0001", "yes"]), "p")]
        calls += [(conv, None, 1, "t", f'{{"n":{i}}}', None, None, None) for i in range(4, 7)] + [(conv, "k1", 0, "t", '{"n":3}', None, None, None)] * 2
    return calls, results


@pytest.mark.parametrize("whole", [4096, 3])
@pytest.mark.parametrize("seed", [1])
def test_against_a_plain_version(spark, monkeypatch, whole, seed):
    monkeypatch.setattr(toolcalls, "WHOLE", whole)
    calls, results = made(seed)
    got = toolcalls.link_calls(spark.createDataFrame(calls, CALLS).repartition(3), spark.createDataFrame(results, RESULTS), SCHEMA).collect()
    ordered = sorted((tuple(r)[:-1] for r in got), key=repr)
    assert ordered == brute(calls, results)
    for r in got:
        want = {"arguments": json.loads(r.arguments), "call_id": r.call_id, "position": r.position, "result": r.result, "status": r.status, "tool": r.tool}
        assert r.json == json.dumps(want, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """120 calls, each needing the one before, and two calls that need many."""
    monkeypatch.setattr(toolcalls, "WHOLE", 10)
    edges = [("=1", i, i - 1) for i in range(1, 120)] + [("=1", 120, i) for i in range(0, 120, 7)] + [("=1", 121, 120), ("=1", 121, 3)]
    rounds = []
    monkeypatch.setattr(toolcalls, "shared_dir", lambda s, f=toolcalls.shared_dir: rounds.append(1) or f(s))
    got = dict(map(tuple, toolcalls.levels_by_rounds(spark.createDataFrame(edges, "conv_key string, v long, u long")).collect()))
    assert got == {i: i for i in range(120)} | {120: 120, 121: 121} and len(rounds) <= 12


def test_kahn():
    assert toolcalls.kahn([(2, 1), (3, 2), (3, 1), (5, 6), (6, 5), (7, 6), (7, 1)]) == {1: 0, 2: 1, 3: 2, 5: -1, 6: -1, 7: -1}


def test_odd_json(spark):
    odd = ['"\\ud800"', '{"\\udfff":"$\\ud800"}', "NaN", "1e999", "[" * 100_000, '{"n":1,"n":4}', "", None, '"' + "é" * 1_000_000 + '"', '{"n":2.5}']
    calls = [(1, f"k{i}", i, "t", x, None, None, None) for i, x in enumerate(odd)]
    got = {r.call_id: r for r in toolcalls.link_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame([], RESULTS), SCHEMA).collect()}
    assert got["k0"].arguments == '"\\ud800"' and json.loads(got["k0"].json)["arguments"] == "\ud800" and got["k0"].problem == "$: not object"
    assert json.loads(got["k1"].arguments) == {"\udfff": "$\ud800"} and got["k5"].arguments == '{"n":4}' and got["k9"].problem == "$.n: not integer"
    assert all(got[f"k{i}"].problem == "not JSON" and got[f"k{i}"].arguments == odd[i] for i in (2, 3, 4, 6, 7)) and json.loads(got["k8"].json)["arguments"] == "é" * 1_000_000


def test_turns_of_every_role(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "which one"), (1, 2, "assistant", "that"), (1, 3, "user", "a b"), (1, 4, None, "odd"), (None, 0, "user", None), (2, None, "user", "x")]
    calls, results = toolcalls.conversation_calls(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link_calls(calls, results, toolcalls.SCHEMAS).collect()}
    assert len(got) == 5 and [got[(1, f"c{i}")].level for i in (0, 1, 3)] == [0, 1, 2] and got[(1, "c3")].result == "odd" and got[(1, "c1")].result == "that"
    assert got[(1, "c0")].tool == "instruct" and got[(None, "c0")].status == "invalid"
