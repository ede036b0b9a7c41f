from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp

WORDS = "the of and to in is that it was for with as on be this by are from house river garden letter window morning people water light paper stone road".split()
TOXIC = "worthless idiot scum moron".split()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small corpus with planted cases; returns (folder, texts)."""
    rng = random.Random(1)
    fresh = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing"]) for _ in range(n))
    bench = [fresh(30) for _ in range(5)]
    texts = [fresh(rng.randint(60, 160)) for _ in range(300)]
    for i in range(200, 280):
        w = texts[i].split()
        for _ in range(12):
            w[rng.randrange(len(w))] = rng.choice(TOXIC)
        texts[i] = " ".join(w)
    copies = {300: texts[0], 301: texts[1] + " tail", 302: texts[0]}
    leaks = {303: fresh(40) + " " + bench[2] + " " + fresh(40)}
    other = {304: "日本語のテキストです。これは日本語で書かれた長い文章です。", 305: "", 306: None}
    everything = dict(enumerate(texts)) | copies | leaks | other
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in everything.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("score", F.lit("own")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(200 <= i < 280)) for i in range(300) if i % 3], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_planted_cases(spark, corpus):
    docs = cp.read(spark, corpus, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.written(stage(spark, docs, corpus), name)
        assert docs.columns == columns
        assert docs.filter("score <> 'own'").count() == 0
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    assert set(range(304)) <= kept["language_id"] and not kept["language_id"] & {304, 305, 306}
    toxic = set(range(200, 280))
    assert len(kept["toxicity"] & toxic) <= 4 and len(set(range(200)) - kept["toxicity"]) <= 4
    assert kept["near_duplicates"] == kept["toxicity"] - {300, 301, 302}
    assert kept["decontamination"] == kept["near_duplicates"] - {303}
    mix = cp.STAGES[-1][1](spark, docs, corpus)
    assert mix.count() == docs.count()


def test_run_and_empty(spark, corpus, sf):
    assert cp.run(spark, sf).count() > 100
    docs = cp.read(spark, corpus, "documents").limit(0)
    for _, stage in cp.STAGES:
        out = stage(spark, docs, corpus)
        assert out.count() == 0


def test_repeated_rows_leave_one(spark, corpus):
    docs = cp.read(spark, corpus, "documents").filter("doc_id < 20")
    twice = cp.checkpoint(docs.unionByName(docs))
    assert cp.drop_near_duplicates(spark, twice, corpus).count() == 20


def test_rows_are_told_apart_without_ids(spark, corpus):
    """Rows without doc_id, or with one doc_id and different texts, are documents of their own."""
    rng = random.Random(2)
    fresh = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))
    leak = spark.read.parquet(f"{corpus}/benchmark.parquet").first().text
    a, b, c, d, e, f = (fresh(80) for _ in range(6))
    rows = [(None, a), (None, b), (None, b), (1, c), (None, c + " tail"), (2, d), (2, e), (2, e), (9, f), (3, f + " tail"), (4, leak + " " + fresh(60)), (4, fresh(70)), (None, fresh(40) + " " + leak)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = lambda df: sorted(((r.doc_id or 0, r.text) for r in df.collect()))
    near = cp.drop_near_duplicates(spark, docs, corpus)
    assert near.columns == docs.columns
    assert got(near) == sorted((i or 0, t) for i, t in [(None, a), (None, b), (1, c), (2, d), (2, e), (3, f + " tail"), *rows[10:]])
    clean = cp.drop_benchmark_leaks(spark, docs, corpus)
    assert clean.columns == docs.columns and got(clean) == sorted((i or 0, t) for i, t in [*rows[:10], rows[11]])
