"""Distributed positions, running totals and previous rows against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from importlens.operators import order


def _rows(seed, n, keys):
    rng = random.Random(seed)
    # one key holds most rows, so its series crosses many partitions
    return [(rng.choice(["hot"] * 6 + keys), i, rng.choice([None, 0, 1, 5])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_running_matches_python(spark, n):
    rows = _rows(1, n, ["a", "b", None])
    df = spark.createDataFrame(rows, "k string, t long, v long").repartition(5)
    got = {(r.k, r.t): (r.position, r.total) for r in order.running(df, ["t"], ["k"], totals={"total": "v"}).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        total = 0
        for i, (_, t, v) in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: r[1])):
            total += v or 0
            want[k, t] = (i + 1, total)
    assert got == want


def test_whole_table_order_and_columns(spark):
    df = spark.createDataFrame([(i, -i) for i in range(500)], "a int, _x int").repartition(7)
    out = order.running(df, [F.desc("a")])
    assert out.columns == ["a", "_x", "position"]
    assert sorted((r.position, r.a) for r in out.collect()) == [(i + 1, 499 - i) for i in range(500)]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_previous_matches_python(spark, by):
    rows = _rows(2, 2000, ["a", None])
    df = spark.createDataFrame(rows, "k string, t long, v long").repartition(6)
    got = {(r.k, r.t): r.p for r in order.previous(df, ["t"], "v", "p", by).collect()}
    want = {}
    for k in ({r[0] for r in rows} if by else {0}):
        last = None
        for key, t, v in sorted((r for r in rows if not by or r[0] == k), key=lambda r: r[1]):
            want[key, t], last = last, v
    assert got == want


def test_no_task_holds_a_series(spark):
    df = spark.range(1000).withColumn("v", F.col("id"))
    plan = order.previous(df, ["id"], "v", "p")._jdf.queryExecution().toString()
    windows = [x for x in plan.split("\n") if "Window [" in x and "row_number()" in x]
    assert windows and all("windowspecdefinition(_part" in x for x in windows)
