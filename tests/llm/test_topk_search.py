"""M-tree search against all products."""

import numpy as np
from pyspark.sql import functions as F

from importlens.llm import topk_search as ts

SCHEMA = "vec_id long, embedding array<double>, score string"


def slow(rows, every, k=5):
    vectors = {}
    for i, v, _ in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([int(np.floor(256 * x)) for x in v])
    out = set()
    for q in vectors:
        if q % every == 0:
            best = {}
            for own in vectors[q]:
                for i, found in vectors.items():
                    for v in found:
                        if i != q and len(v) == len(own):
                            best[i] = max(best.get(i, -1 << 62), sum(a * b for a, b in zip(own, v)))
            ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
            out |= {(q, r, i, s) for r, (i, s) in enumerate(ranked, 1)}
    return out


def corpus(n=700):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6))
    rows = [(i, (centres[i % 12] + 0.2 * rng.normal(size=6)).tolist(), "x") for i in range(n)]
    same = rows[17][1]
    rows += [(1000 + i, same, None) for i in range(120)]                       # a large group of copies
    rows += [(2000, None, "x"), (2001, [None] * 6, "x"), (2002, [float("nan")] + [1.0] * 5, "x"),
             (2003, [float("inf")] * 6, "x"), (None, same, "x"), (2050, [], "x"), (2051, [], "x"), (2100, [1.0, 2.0], "x"),
             rows[50], (2150, [0.0] * 6, "x")]
    return rows


def test_same_as_all_products(spark):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for shard_rows in (100, 16384):
        got = ts.top_products(ts.integer_vectors(frame), F.col("vec_id") % 50 == 0, shard_rows=shard_rows)
        assert {tuple(r) for r in got.collect()} == slow(rows, 50)


def test_bounds_save_products():
    rng = np.random.default_rng(1)
    x = np.floor(256 * (np.repeat(rng.normal(size=(40, 8)), 100, axis=0) + 0.02 * rng.normal(size=(4000, 8)))).astype(np.int64)
    tree = ts.MTree(x)
    for row in range(0, 4000, 200):
        got = tree.search(x[row], 5, lambda i: [int(i)])
        want = sorted(((-int(p), i) for i, p in enumerate(x @ x[row])))[:5]
        assert got == want
    assert tree.computed < 20 * len(x) / 2


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert ts.top_products(ts.integer_vectors(frame), F.col("vec_id") % 50 == 0).collect() == []


def test_ids_with_several_vectors(spark):
    # id 1 fills eight of the best places; the next ids must still be found
    rows = [(0, [1.0], "q")] + [(1, [1.0 - n / 64], "x") for n in range(8)] + [(i, [0.5 - i / 64], "x") for i in range(2, 9)]
    rng = np.random.default_rng(5)
    rows += [(int(i), rng.normal(size=3).tolist(), "x") for i in rng.integers(0, 120, size=900)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert {(0, r, 1 if r == 1 else r) for r in range(1, 6)} <= {(a, b, c) for a, b, c, _ in slow(rows[:16], 50)}
    for shard_rows in (40, 16384):
        got = ts.top_products(ts.integer_vectors(frame), F.col("vec_id") % 50 == 0, shard_rows=shard_rows)
        assert {tuple(r) for r in got.collect()} == slow(rows, 50)


def test_shared_paths_are_qualified(spark, tmp_dir):
    from importlens.llm.common import shared_uri
    conf = spark._jsc.hadoopConfiguration()
    assert shared_uri(spark, tmp_dir) == f"file://{tmp_dir}" == shared_uri(spark, f"file:{tmp_dir}")
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://shared/")
    conf.set("fs.viewfs.mounttable.shared.link./work", f"file:{tmp_dir}")
    try:        # a path without a scheme is on the default file system, not on the executor's disk
        assert shared_uri(spark, "/work/x") == "viewfs://shared/work/x"
    finally:
        conf.set("fs.defaultFS", before)
