"""Language and quality predictions: held-out accuracy on the given tables, and defined results."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from importlens.llm import language_id as li
from importlens.llm import quality as ql

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string"


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = li.op10_language_id(spark, SF).join(docs, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    right = [r.lang == r.lang_pred for r in got if r.lang is not None]
    assert len(right) > 100 and np.mean(right) > 0.9
    assert all(0 <= r.score <= 1 for r in got)
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)


def test_quality_held_out_ranking(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = ql.op3_quality(spark, SF).where("held_out").join(labels, "doc_id").where("quality is not null").collect()
    good, bad = ([r.score for r in got if r.quality == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.8
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)


def test_gram_counts_do_not_depend_on_chunks(monkeypatch):
    text = "Ab, cd! ÉÑ 42 ef  gh " * 50
    whole = li.gram_counts(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(li, "CHUNK", size)
        assert (li.gram_counts(text) == whole).all()


def sample():
    rng = random.Random(2)
    words = {"en": "the of and house water which".split(), "de": "der und das haus wasser welche".split(),
             "ru": "дом вода который это".split()}
    rows = [(i, " ".join(rng.choices(words[g], k=30)), g, "a") for i, g in enumerate(["en", "de", "ru"] * 40)]
    return rows + [(500, None, "en", "a"), (501, "", None, "a"), (502, "12 34", "de", "a"), (None, "the house", "en", "a"),
                   (503, "the water " * 200_000, None, None), rows[4]]


def test_language_defined_results(spark):
    docs = spark.createDataFrame(sample(), DOCS).withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1))
    model = li.train(docs, F.lit(True))
    got = li.predict(docs, model).collect()
    assert len(got) == len(sample())
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by_id[503].lang_pred == "en"
    assert all(by_id[r[0]].lang_pred == r[2] for r in sample()[:120])
    kept = li.accepted(docs)
    assert kept.columns == docs.columns
    assert {500, 501, 502}.isdisjoint(r.doc_id for r in kept.select("doc_id").collect())
    empty = docs.limit(0)
    assert li.train(empty, F.lit(True)) is None
    assert li.accepted(empty).collect() == [] and {r.lang_pred for r in li.predict(docs, None).collect()} == {"und"}


def test_quality_defined_results(spark):
    docs = spark.createDataFrame(sample(), DOCS).withColumn("quality", F.lit("x")).withColumn("stats", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(120)] + [(3, None, 1), (None, 1, 2), (5, 1, 3)],
                                   "doc_id long, quality int, stats int")
    stats = ql.document_statistics(docs)
    model = ql.train(stats, labels, F.lit(True))
    got = ql.scores(stats, model).collect()
    assert len(got) == len(sample()) and all(0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add(r.score)
    assert by_id[500] == by_id[501] and len(by_id[500]) == 1
    assert ql.train(stats, labels.limit(0), F.lit(True)) is None
    assert {r.score for r in ql.scores(stats, None).collect()} == {0.5}
    assert ql.scores(ql.document_statistics(docs.limit(0)), model).collect() == []


def test_trees_walk_as_their_arrays_say():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = ql.Trees(x, y, rounds=30, depth=3)
    p = trees.score(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.95
    for row in range(0, 600, 50):
        bins, total = trees.binned(x[row:row + 1])[0], trees.base
        for k in range(30):
            node = 0
            for _ in range(3):
                node = trees.left[k, node] + (bins[trees.feature[k, node]] > trees.bin[k, node])
            total += trees.value[k, node]
        assert abs(p[row] - 1 / (1 + np.exp(-total))) < 1e-12


def test_doubtful_texts_go_and_held_out_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = ["qzxjk vvkq wxzj", "zq", "Привет мир это дом и вода", "日本語の文章です", "asdf jkl; qwer uiop"]
    texts = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(junk)], "doc_id long, text string")
    with_junk = docs.unionByName(texts, allowMissingColumns=True)
    kept = {r.doc_id for r in li.accepted(with_junk).select("doc_id").collect()}
    assert not {-1 - i for i in range(len(junk))} & kept
    held = docs.where((li.fold(F.col("doc_id"), 4) == 2) & F.col("text").rlike(r"\p{L}")).select("doc_id").collect()
    assert len(held) > 100 and {r.doc_id for r in held} <= kept
