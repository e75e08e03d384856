"""Benchmark decontamination against a plain comparison of word shingles."""

import random
import re

from importlens.llm import decontaminate as dc


def shingles(text, width):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def slow(docs, items):
    out = set()
    for item_id, text in items:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        own = shingles(text, min(5, len(words))) if words else set()
        for doc_id, body in docs:
            held = own & shingles(body, min(5, len(words))) if own else set()
            if own and len(held) >= 0.8 * len(own):
                out.add((doc_id, item_id, len(own), len(held)))
    return out


def corpus():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 4, 5, 6, 9, 12, 20, 33, 64, 65])]
    items += [(50, None), (51, ""), (52, " .,! "), (53, items[6][1].upper().replace(" ", ", "))]
    docs = []
    for i in range(60):
        body = text(rng.randrange(0, 200)).split()
        part = list(items[i % 11][1].split())
        for _ in range(i % 4):          # some damage: still, or no longer, contained
            part[rng.randrange(len(part))] = "damage"
        at = rng.randrange(len(body) + 1)
        docs.append((i, " ".join(body[:at] + part + body[at:])))
    docs += [(100, None), (101, ""), (102, "?!"), (5, docs[5][1]), (None, items[8][1]), (103, "x " * 5000 + items[9][1])]
    return docs, items


def test_same_as_brute_force(spark):
    docs, items = corpus()
    got = dc.contained_items(spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id"),
                             spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long"))
    rows = [tuple(r)[:4] for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == slow(docs, items)


def test_contaminated_documents_go_and_columns_stay(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(*r, "en") for r in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = dc.remove_contaminated(frame, bench)
    bad = {r[0] for r in slow(docs, items)}
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in bad)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words of a text here")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contained_items(docs, none).collect() == []
    assert dc.remove_contaminated(docs, none).count() == 1
    assert dc.contained_items(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []


def test_rows_of_one_id_are_decided_by_their_own_text(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    words = item.split()
    rows = [(None, "so " + item), (None, "a clean text"), (7, item + " end"), (7, "another clean text"), (7, None),
            (8, " ".join(words[:8])), (8, " ".join(words[4:]))]     # 4 and 6 of 10 shingles, together all
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dc.remove_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(str(r) for i, r in enumerate(rows) if i not in (0, 2))


def test_query_takes_each_text_for_itself(spark, tmp_dir):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    words = item.split()
    rows = [(None, " ".join(words[:8])), (None, " ".join(words[4:])), (1, item), (1, item), (1, "x " + item), (2, " ".join(words[:8])), (2, " ".join(words[4:]))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(9, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = dc.op6_decontaminate(spark, tmp_dir)
    assert got.columns == ["doc_id", "item_id", "n_shingles", "matched", "containment"]
    assert sorted(map(tuple, got.collect())) == [(1, 9, 10, 10, 1.0)] * 2
