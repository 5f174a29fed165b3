"""Chat formatting: tool calls linked to their results.

Calls and results meet in a hash join on conversation and identifier. Calls of a conversation are put in topological
order by the results that their arguments refer to: a call's level is one more than the highest level of the calls it
needs. Only numbers (the edges) take part in that. Conversations of up to WHOLE edges are ordered in one pass of Kahn's method
in tasks; longer ones by rounds that place what needs nothing open and let every edge jump over calls with a single open need, so
a chain of n calls takes about log2(n) rounds. Places in a conversation come from a range sort with offsets for each
range, so a conversation of any length is many tasks. Arguments are validated against the tools' schemas and everything is
written as canonical JSON (sorted keys, no blanks).
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dirspark.llm.common import nullsafe, settle, shared_dir, table

#: A small subset of JSON Schema: type, required, properties, additionalProperties, enum, items, minimum, maximum, maxLength.
TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
#: Edges of a conversation that one task orders at once.
WHOLE = 4096
#: Longest way that is told apart; only circles reach it.
FAR = 1 << 40
SURROGATE = re.compile("[\ud800-\udfff]")


def plain(text: str) -> str:
    """Lone surrogates, which no UTF-8 text can hold, written as JSON escapes."""
    return SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: object) -> str:
    return plain(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def fault(value: object, schema: dict, at: str = "$") -> str | None:
    """The first violation, in a fixed order; null if value is valid."""
    kind = schema.get("type")
    if kind == "integer":
        ok = isinstance(value, int) and not isinstance(value, bool)
    elif kind == "number":
        ok = isinstance(value, (int, float)) and not isinstance(value, bool)
    else:
        ok = kind is None or isinstance(value, TYPES[kind])
    if not ok:
        return f"{at}: not {kind}"
    if "enum" in schema and canonical(value) not in map(canonical, schema["enum"]):
        return f"{at}: not in enum"
    if isinstance(value, (int, float)) and not isinstance(value, bool) and (value < schema.get("minimum", value) or value > schema.get("maximum", value)):
        return f"{at}: out of range"
    if isinstance(value, str) and len(value) > schema.get("maxLength", len(value)):
        return f"{at}: too long"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for k in sorted(schema.get("required", [])):
            if k not in value:
                return f"{at}.{k}: missing"
        for k in sorted(value):
            if k not in known and schema.get("additionalProperties") is False:
                return f"{at}.{k}: unknown"
            if k in known and (found := fault(value[k], known[k], f"{at}.{k}")):
                return found
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            if found := fault(x, schema["items"], f"{at}[{i}]"):
                return found
    return None


def references(value: object) -> list[str]:
    """Identifiers that strings of the form $id refer to, at any depth, each once. One with a lone surrogate names no call."""
    found, stack = {}, [value]
    while stack:
        x = stack.pop()
        if isinstance(x, dict):
            stack += list(x.values())[::-1]
        elif isinstance(x, list):
            stack += x[::-1]
        elif isinstance(x, str) and x.startswith("$") and len(x) > 1 and not SURROGATE.search(x):
            found[x[1:]] = None
    return list(found)


def parsed(raw: str | None, schema: dict | None) -> tuple[str | None, str | None, list[str]]:
    """Canonical arguments (the raw text where it isn't JSON), the problem if there is one, and the identifiers needed."""
    try:
        value = json.loads(raw or "")
        text = canonical(value)
    except (ValueError, RecursionError):
        return raw, "not JSON", []
    problem = fault(value, schema) if schema is not None else "unknown tool"
    return text, problem and plain(problem), references(value)


def parsed_calls(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """calls (conv_key, call_id, seq, tool, arguments, conv_id) with canonical arguments, problem and needs (identifiers referred to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [parsed(raw, schemas.get(tool)) for tool, raw in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            told, problems, needs = zip(*got, strict=True) if got else ((), (), ())
            yield pa.record_batch([*batch.columns[:4], pa.array(told, pa.string()), batch.column(5), pa.array(problems, pa.string()), pa.array(needs, pa.list_(pa.string()))], [*names, "problem", "needs"])

    names = ["conv_key", "call_id", "seq", "tool", "arguments", "conv_id"]
    rows = calls.select(*names)
    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", problem string, needs array<string>")


def kahn(edges: list[tuple[int, int]]) -> dict[int, int]:
    """Levels of the nodes of edges (node, need): 0 where nothing is needed, -1 in or behind a circle."""
    needed_by, open_needs, level = defaultdict(list), defaultdict(int), {}
    for v, u in edges:
        needed_by[u].append(v)
        open_needs[v] += 1
    ready = [u for u in needed_by if u not in open_needs]
    level.update(dict.fromkeys(ready, 0))
    reached = defaultdict(int)
    while ready:
        u = ready.pop()
        for v in needed_by.get(u, ()):
            reached[v] = max(reached[v], level[u] + 1)
            open_needs[v] -= 1
            if not open_needs[v]:
                level[v] = reached[v]
                ready.append(v)
    return level | {v: -1 for v, n in open_needs.items() if n}


def levels_whole(edges: DataFrame) -> DataFrame:
    """node and level of edges (conv_key, v, u) of conversations that a task takes whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def placed() -> pa.RecordBatch:
            found = kahn(held)
            return pa.record_batch([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], ["node", "level"])

        for batch in batches:
            for k, v, u in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if held:
                        yield placed()
                    key, held = k, []
                held.append((v, u))
        if held:
            yield placed()

    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.select("conv_key", "v", "u").repartition(n, "conv_key").sortWithinPartitions("conv_key").mapInArrow(run, "node long, level long")


def raised(nodes: DataFrame, bases: DataFrame) -> DataFrame:
    """nodes (node, base) with bases raised to those in (v, b)."""
    highest = bases.groupBy(F.col("v").alias("node")).agg(F.max("b").alias("b"))
    return nodes.join(highest, "node", "left").select("node", F.greatest("base", F.coalesce("b", "base")).alias("base"))


def levels_by_rounds(edges: DataFrame) -> DataFrame:
    """node and level of edges (v, u) in conversations of any length.

    A node's level is the largest of its base and, over its open edges, the level of the need plus the edge's weight. In a
    round, nodes without open edges are placed at their base and edges to them become part of the base; then edges to nodes
    with one open edge jump to what that one leads to. Where no node is without open edges, all that are left lead to a circle.
    """
    spark, c, done = edges.sparkSession, F.col, []
    edges = settle(edges.select("v", "u", F.lit(1).cast("long").alias("w")), "edges")
    nodes = settle(edges.select(c("v").alias("node")).union(edges.select("u")).distinct().withColumn("base", F.lit(0).cast("long")), "nodes")
    while not nodes.isEmpty():
        free = nodes.join(edges.select(c("v").alias("node")).distinct(), "node", "left_anti")
        free = settle(free.select("node", c("base").alias("level")), "free")
        circular = free.isEmpty()
        done.append(f"{shared_dir(spark)}/placed")
        (nodes.select("node", F.lit(-1).cast("long").alias("level")) if circular else free).write.parquet(done[-1])
        if circular:
            break
        met = settle(edges.join(free.withColumnRenamed("node", "u"), "u", "left"), "met")
        edges = met.where("level IS NULL").select("v", "u", "w")
        nodes = settle(raised(nodes.join(free, "node", "left_anti"), met.where("level IS NOT NULL").select("v", (c("level") + c("w")).alias("b"))).join(
            edges.groupBy(c("v").alias("node")).agg(F.count(F.lit(1)).alias("n"), F.max("u").alias("nu"), F.max("w").alias("nw")), "node", "left"), "nodes")
        jump = c("n") == 1
        met = settle(edges.join(nodes.withColumnRenamed("node", "u"), "u"), "met")
        nodes = settle(raised(nodes.select("node", "base"), met.where(jump).select("v", (c("base") + c("w")).alias("b"))), "nodes")
        edges = met.select("v", F.when(jump, c("nu")).otherwise(c("u")).alias("u"), F.when(jump, F.least(c("w") + c("nw"), F.lit(FAR))).otherwise(c("w")).alias("w"))
        edges = settle(edges.groupBy("v", "u").agg(F.max("w").alias("w")), "edges")
    return spark.read.schema("node long, level long").parquet(*done)


def levels(rows: DataFrame) -> DataFrame:
    """node and level of the calls that need another or are needed; the rest have level 0."""
    named = rows.where("call_id IS NOT NULL")
    wanted = named.select("conv_key", F.col("node").alias("v"), F.explode(F.array_distinct("needs")).alias("call_id"))
    edges = settle(wanted.join(named.select("conv_key", "call_id", F.col("node").alias("u")), ["conv_key", "call_id"]).select("conv_key", "v", "u"), "edges")
    long = settle(edges.groupBy("conv_key").count().where(F.col("count") > WHOLE).select("conv_key"), "long")
    if long.isEmpty():
        return levels_whole(edges)
    return levels_whole(edges.join(long, "conv_key", "left_anti")).unionByName(levels_by_rounds(edges.join(long, "conv_key", "left_semi")))


def places(rows: DataFrame) -> DataFrame:
    """node and position (from 1) of rows (conv_key, node, level, seq, call_id, tool, tie) in their conversation's order; circular ones (level -1) last.

    Rows are range-sorted as a whole. Each range numbers its conversations from 1; a conversation in several ranges adds what earlier
    ranges have of it. There are fewer such pieces than twice the ranges.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_key", "last", "level", "seq", "call_id", "tool", "tie"]
    rows = settle(rows.withColumn("last", F.col("level") < 0).select("node", *order), "unplaced")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, key, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys, numbers = batch.column(1).to_pylist(), np.empty(batch.num_rows, dtype=np.int64)
            for i, k in enumerate(keys):
                seen = seen + 1 if k == key else 1
                key, numbers[i] = k, seen
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.full(len(keys), part), pa.int32()), pa.array(numbers)], ["node", "conv_key", "part", "number"])

    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("node", "conv_key")
    numbered = settle(dealt.mapInArrow(run, "node long, conv_key string, part int, number long"), "numbered")
    pieces = numbered.groupBy("conv_key", "part").agg(F.max("number").alias("n"))
    several = pieces.groupBy("conv_key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("conv_key")
    before = Window.partitionBy("conv_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(pieces.join(several, "conv_key").select("conv_key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    return numbered.join(F.broadcast(offsets), ["conv_key", "part"], "left").select("node", (F.col("number") + F.coalesce("offset", F.lit(0))).alias("position"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call: position in its conversation's topological order, problem, result and the JSON of both.

    calls: conv_id, call_id, seq, tool, arguments (text). results: conv_id, call_id, seq, content. Of several results of a call the
    first counts (ties: the smallest content); of several calls with one identifier, the first (by seq, then tool and arguments). A result
    counts only behind its call; one that answers no call gives no row. Calls in a circle or behind one have level -1 and come last. Null
    identifiers link nothing: such calls have no result. Null conversations are one of their own. Rows of one level are ordered by
    seq (null first), identifier, tool and arguments. Arguments that aren't JSON, or hold NaN or infinities, stay as they are.
    """
    c = F.col
    kind = calls.schema["conv_id"].dataType.simpleString()
    keyed = calls.select(nullsafe("conv_id").alias("conv_key"), "conv_id", "call_id", c("seq").cast("long").alias("seq"), "tool", "arguments")
    first = keyed.where("call_id IS NOT NULL").groupBy("conv_key", "conv_id", "call_id").agg(F.min(F.struct("seq", "tool", "arguments")).alias("m")).select("conv_key", "conv_id", "call_id", "m.*")
    rows = parsed_calls(first.unionByName(keyed.where("call_id IS NULL")), schemas)
    rows = settle(rows.withColumn("node", F.monotonically_increasing_id()), "calls")
    levelled = rows.select("node", "conv_key", "seq", "call_id", "tool", F.md5("arguments").alias("tie")).join(levels(rows), "node", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    levelled = settle(levelled, "levels")
    placed = levelled.select("node", "level").join(places(levelled), "node")
    answers = results.where("call_id IS NOT NULL").select(nullsafe("conv_id").alias("conv_key"), "call_id", c("seq").alias("result_seq"), "content")
    pairs = rows.select("conv_key", "call_id", "seq", "node").join(answers, ["conv_key", "call_id"]).where(c("result_seq") > c("seq"))
    answered = pairs.groupBy("node").agg(F.min(F.struct("result_seq", "content")).alias("_r")).select("node", c("_r.content").alias("result"), F.lit(True).alias("answered"))
    out = rows.join(placed, "node").join(answered, "node", "left")
    out = out.withColumn("status", F.when(c("problem").isNotNull(), "invalid").when(c("level") < 0, "circular").when(c("answered").isNull(), "unanswered").otherwise("linked"))

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for r in batch.select(told).to_pylist():
                # Canonical arguments go in as they are; what isn't JSON is a string.
                arguments = canonical(r["arguments"]) if r["problem"] == "not JSON" else r["arguments"]
                rest = canonical({k: r[k] for k in ("call_id", "position", "result", "status", "tool")})
                texts.append(f'{{"arguments":{arguments},{rest[1:]}')
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "json"])

    told = ["call_id", "tool", "position", "status", "problem", "arguments", "result"]
    fields = ["conv_id", "call_id", "seq", "tool", "level", "position", "status", "problem", "arguments", "result"]
    schema = f"conv_id {kind}, call_id string, seq long, tool string, level long, position long, status string, problem string, arguments string, result string"
    return out.select(*fields).mapInArrow(serialise, schema + ", json string")


SCHEMAS = {
    "instruct": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string"}, "after": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False},
    "search": {"type": "object", "required": ["query"], "properties": {"query": {"type": "string", "maxLength": 400}, "after": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False},
    "summarise": {"type": "object", "required": ["words"], "properties": {"words": {"type": "integer", "minimum": 5}, "after": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False},
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that conversations stand for: each user turn asks a tool about its whole text, each system turn instructs one, and each
    other turn is the result of the turn before it.

    A call's identifier is its turn's number. A user turn of 3 or more characters in its first word searches, another one summarises. A call needs
    the two turns before it as far as they are calls.
    """
    t = F.coalesce("text", F.lit(""))
    n = F.size(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != F.lit("")))
    tool = F.when(F.col("role") == "system", "instruct").when(F.length(F.regexp_extract(t, r"[^\x20\x09-\x0D]+", 0)) >= 3, "search").otherwise("summarise")
    after = F.when(F.col("turn") >= 1, F.array(*[F.concat(F.lit("$c"), (F.col("turn") - k).cast("string")) for k in (1, 2)])).alias("after")
    told = F.when(tool == "instruct", F.to_json(F.struct(t.alias("text"), after))).when(tool == "search", F.to_json(F.struct(t.alias("query"), after))).otherwise(F.to_json(F.struct(n.alias("words"), after)))
    asks = F.coalesce(F.col("role").isin("user", "system"), F.lit(False))
    asked = turns.where(asks).select("conv_id", F.concat(F.lit("c"), F.col("turn").cast("string")).alias("call_id"), F.col("turn").alias("seq"), tool.alias("tool"), told.alias("arguments"))
    answered = turns.where(~asks).select("conv_id", F.concat(F.lit("c"), (F.col("turn") - 1).cast("string")).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    return asked, answered


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All calls of all conversations, linked, ordered, validated and serialised."""
    out = link_calls(*conversation_calls(table(spark, sf_dir, "conversations")), SCHEMAS)
    return out.select("conv_id", "call_id", "tool", "level", "position", "status", "problem", F.sha2("json", 256).alias("json_sha256"))


ORACLE = r"""
WITH RECURSIVE turns AS (SELECT conv_id, coalesce('=' || conv_id, '') AS conv_key, turn, role, text, coalesce(text, '') AS t FROM conversations),
asked AS (
  SELECT *, CASE WHEN role = 'system' THEN 'instruct' WHEN length(regexp_extract(t, '[^\x20\x09-\x0D]+')) >= 3 THEN 'search' ELSE 'summarise' END AS tool,
    len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS n, CASE WHEN turn >= 1 THEN '"after":["$c' || (turn - 1) || '","$c' || (turn - 2) || '"],' ELSE '' END AS after
  FROM turns WHERE role IN ('user', 'system')),
calls AS (
  SELECT conv_key, conv_id, turn, tool, '{' || after || CASE tool WHEN 'instruct' THEN '"text":' || CAST(to_json(t) AS VARCHAR) WHEN 'search' THEN '"query":' || CAST(to_json(t) AS VARCHAR) ELSE '"words":' || n END || '}' AS arguments,
    CASE WHEN tool = 'search' AND length(t) > 400 THEN '$.query: too long' WHEN tool = 'summarise' AND n < 5 THEN '$.words: out of range' END AS problem, row_number() OVER (PARTITION BY conv_key ORDER BY turn) AS k
  FROM asked),
walk AS (
  SELECT conv_key, k, turn, CAST(0 AS BIGINT) AS level, CAST(NULL AS BIGINT) AS turn1, CAST(NULL AS BIGINT) AS level1 FROM calls WHERE k = 1
  UNION ALL
  SELECT c.conv_key, c.k, c.turn, greatest(CASE WHEN w.turn >= c.turn - 2 THEN w.level + 1 ELSE 0 END, CASE WHEN w.turn1 >= c.turn - 2 THEN w.level1 + 1 ELSE 0 END), w.turn, w.level
  FROM walk w JOIN calls c ON c.conv_key = w.conv_key AND c.k = w.k + 1),
placed AS (SELECT conv_key, turn, level, row_number() OVER (PARTITION BY conv_key ORDER BY level, turn) AS position FROM walk),
results AS (SELECT conv_key, turn - 1 AS turn, text FROM turns WHERE role IS NULL OR role NOT IN ('user', 'system')),
linked AS (
  SELECT c.*, p.level, p.position, r.text AS result, CASE WHEN c.problem IS NOT NULL THEN 'invalid' WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status
  FROM calls c JOIN placed p USING (conv_key, turn) LEFT JOIN results r USING (conv_key, turn))
SELECT conv_id, 'c' || turn AS call_id, tool, level, position, status, problem,
  sha256('{"arguments":' || arguments || ',"call_id":"c' || turn || '","position":' || position || ',"result":' || coalesce(CAST(to_json(result) AS VARCHAR), 'null') || ',"status":"' || status || '","tool":"' || tool || '"}') AS json_sha256
FROM linked
"""
