"""The pipeline: stages in order, each on all that its predecessor kept."""

import corpus_pipeline as cp
from importlens.llm import decontaminate, language_id, line_dedup, sentencepiece_codec, simhash_dedup

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators(spark):
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash_dedup", "decontaminate", "sentencepiece"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    one = language_id.accepted(docs)
    two = line_dedup.deduplicated(one)
    three = simhash_dedup.keep_one(two)
    four = decontaminate.remove_contaminated(three, bench)
    for frame in (one, two, three, four):
        assert frame.columns == docs.columns
    want = sorted(map(str, sentencepiece_codec.encoded(four).collect()))
    assert sorted(map(str, cp.run(spark, SF).collect())) == want
    assert 0 < len(want) <= docs.count()


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    text = max((r[1] for r in rows if r[1]), key=len)
    rows += rows[:3] + [(None, text, None, None, None), (None, None, None, None, None), (900001, "", "en", "x", 0),
                        (900002, None, "en", "x", None), (900003, "word " * 60_000, "en", "x", 1)]
    frame = spark.createDataFrame(rows, docs.schema).selectExpr(
        "*", "'k' AS line", "1 AS number", "2 AS id", "'t' AS task", "3 AS component_id", "4 AS item_id")
    for _, stage in cp.STAGES[:-1]:
        frame = cp.written(stage(spark, frame, SF), "stage")
        assert frame.columns[:5] == docs.columns and set(frame.columns) >= {"line", "number", "id", "task", "component_id", "item_id"}
        assert {(r.line, r.number, r.id, r.task, r.component_id, r.item_id) for r in frame.collect()} <= {("k", 1, 2, "t", 3, 4)}
    encoded = cp.STAGES[-1][1](spark, frame, SF)
    assert encoded.count() == frame.count() and 0 < frame.count() < len(rows)
