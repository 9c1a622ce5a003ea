import re

import pytest

import __spark_entry__
import corpus_pipeline

from test_neardup import sets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows that each stage gets and returns."""
    out = []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.checkpointed(stage(spark, docs, SF))
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def test_columns_and_order(stages):
    assert list(stages) == ["language_id", "near_dedup", "decontamination", "pii", "bpe"]
    for _name, (before, after) in list(stages.items())[:-1]:
        assert dict(after.dtypes) == dict(before.dtypes)


def test_language_keeps_prose(stages):
    before, after = stages["language_id"]
    assert after.count() >= 0.98 * before.filter("length(text) > 20").count()


def test_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    own = [(r["doc_id"], sets(r["text"], 5)) for r in before.collect()]
    kept = {r["doc_id"] for r in after.collect()}

    def near(a, b):
        both = len(a & b)
        return both and 100 * both >= 80 * (len(a) + len(b) - both)

    for i, (doc, s) in enumerate(own):
        if doc in kept:
            assert not any(near(s, t) for other, t in own[:i] if other in kept)
        else:
            assert any(near(s, t) for other, t in own if other != doc)


def test_no_window_of_the_benchmark_is_left(spark, stages):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = set()
    for (text,) in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect():
        w = word.findall(text.lower())
        wins |= {tuple(w[a : a + 10]) for a in range(max(1, len(w) - 9))}
    before, after = stages["decontamination"]
    kept = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        w = word.findall(r["text"].lower())
        assert (r["doc_id"] in kept) == (not any(tuple(w[a : a + 10]) in wins for a in range(len(w))))


def test_private_values_are_gone(stages):
    before, after = stages["pii"]
    find = re.compile(r"\S+@\S+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}")
    old = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        values = find.findall(old[r["doc_id"]])
        assert not any(v in r["text"] for v in values)
        assert values or re.search(r"\d", old[r["doc_id"]]) or r["text"] == old[r["doc_id"]]


def test_run_is_the_stages(spark, stages):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    last = stages["bpe"][1]
    assert last.count() == stages["pii"][1].count()
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(last.columns)
