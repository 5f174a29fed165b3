import os
import re
from collections import Counter, defaultdict

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from dirspark.llm.common import settle
from dirspark.llm import bpe, mixing, neardup, quality, suffixes
from rows import doc_rows
from test_neardup import brute as brute_components
from test_suffixes import brute as brute_suffixes

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def corpus(spark):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in doc_rows()], COLUMNS)


def test_stages_follow_each_other(spark):
    docs, out = corpus(spark), []
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1] if out else settle(docs), "")))
    kept, single, cut, mixed, encoded = out
    assert all(df.columns == names for df in out[:-1])
    verdicts = quality.quality(docs, ["doc_id", "text"]).where("kept").select("doc_id", "text")
    assert Counter(kept.select("doc_id", "text").collect()) == Counter(verdicts.collect())
    alive = {d for d, n, c, ok in brute_components([(r.doc_id, r.text) for r in kept.collect()]) if ok}
    assert {r.doc_id for r in single.collect()} == alive
    want = {(d, n - gone) for d, n, gone, _, _ in brute_suffixes([(r.doc_id, r.text) for r in single.collect()]) if n > gone}
    assert {(r.doc_id, len(r.text.encode())) for r in cut.collect()} == want
    plan = {(r.doc_id, r.text): r for r in mixing.plan_mix(cut, ["doc_id", "text"]).collect()}
    taken = defaultdict(int)
    for r in mixed.collect():
        taken[r.doc_id] += len(words(r.text))
    assert dict(taken) == {d: r.taken for (d, _), r in plan.items() if r.taken}
    library = Tokenizer.from_file(bpe.tokenizer_path())
    for r in encoded.collect():
        assert np.frombuffer(r.ids, dtype="<u4").tolist() == library.encode(r.text, add_special_tokens=False).ids
    assert Counter(r.text for r in encoded.collect()) == Counter(r.text for r in mixed.collect())


def test_a_stage_removes_what_the_one_before_settled(spark, tmp_path):
    """Its own tables stay until its rows are written, and those that the next stage's input still reads stay longer."""
    docs, root = corpus(spark), spark.conf.get("spark.checkpoint.dir")
    others = set(os.listdir(root)) if os.path.isdir(root) else set()
    settled = lambda: {x for x in os.listdir(root) if x not in others and os.listdir(f"{root}/{x}")}
    steps = [f for _, f in corpus_pipeline.STAGES[:3]]
    steps[0](spark, docs, "").write.parquet(f"{tmp_path}/0")
    first = settled()
    steps[1](spark, spark.read.parquet(f"{tmp_path}/0"), "").write.parquet(f"{tmp_path}/1")
    second = settled()
    steps[2](spark, spark.read.parquet(f"{tmp_path}/1"), "").write.parquet(f"{tmp_path}/2")
    assert first and second and not first & second and not settled() & (first | second)
    lazy = docs
    for f in steps:
        lazy = f(spark, lazy, "")
    assert Counter(lazy.select("doc_id", "text").collect()) == Counter(spark.read.parquet(f"{tmp_path}/2").select("doc_id", "text").collect())


def test_empty(spark, tmp_path):
    corpus(spark).where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_other_columns_survive(spark, docs):
    for stage in (quality.keep_good, neardup.keep_first, suffixes.without_repeats, mixing.mix):
        out = stage(docs)
        assert out.columns == docs.columns and out.count() > 0
