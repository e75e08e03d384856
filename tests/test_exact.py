"""Order-free sums against exact rational arithmetic and the SQL twin."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window

from importlens.functions.exact import exact_sum, sql_exact_sum, total


def _values(seed, n=400):
    rng = random.Random(seed)
    return [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.choice([-3, 0, 2, 5, 16, 20, 30, 40]) for _ in range(n)] + [None, 0.0, -0.0, 0.01]


@pytest.mark.parametrize("seed", range(3))
def test_order_free_and_close_to_exact(spark, seed):
    values = _values(seed)
    exact = float(sum(Fraction(v) for v in values if v is not None))
    found = set()
    for k in range(3):
        random.Random(k).shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(1 + 3 * k)
        found.add(df.agg(exact_sum("v")).first()[0])
    assert len(found) == 1 and math.isclose(found.pop(), exact, rel_tol=1e-15)


def test_cancelling_values_keep_small_ones(spark):
    df = spark.createDataFrame([(x,) for x in (1e40, 1.0, -1e40, 1e16, 0.25, -1e16, 1e-20)], "v double")
    assert df.agg(exact_sum("v")).first()[0] == 1.25 + 1e-20


def test_nulls_infinity_and_types(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", float("inf")), ("c", 1e300), ("c", 2.0), ("d", float("nan"))], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(exact_sum("v").alias("s")).collect()}
    assert got["a"] is None and got["b"] == float("inf") and got["c"] == 1e300 and math.isnan(got["d"])
    assert df.where("false").agg(exact_sum("v")).first()[0] is None
    exact = spark.sql("SELECT CAST(0.1 AS DECIMAL(18,2)) AS v")
    assert str(exact.agg(total(exact, "v")).first()[0]) == "0.10"


def test_window_pivot_and_one_pass(spark):
    df = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("b", 1, 0.3)], "k string, p int, v double")
    assert {r.s for r in df.select(exact_sum("v", Window.partitionBy()).alias("s")).collect()} == {float(sum(map(Fraction, (0.1, 0.2, 0.3))))}
    wide = {r.k: (r["1"], r["2"]) for r in df.groupBy("k").pivot("p", [1, 2]).agg(exact_sum("v")).collect()}
    assert wide == {"a": (0.1, 0.2), "b": (0.3, None)}
    plan = df.groupBy("k").agg(exact_sum("v").alias("s"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


@pytest.mark.parametrize("seed", range(2))
def test_sql_twin_is_bit_equal(spark, seed, tmp_dir):
    duckdb = pytest.importorskip("duckdb")
    rows = [(f"k{i % 7}", v) for i, v in enumerate(_values(seed, 3000))]
    spark.createDataFrame(rows, "k string, v double").repartition(5).write.parquet(f"{tmp_dir}/t")
    got = dict(spark.read.parquet(f"{tmp_dir}/t").groupBy("k").agg(exact_sum("v")).collect())
    want = dict(duckdb.sql(f"SELECT k, {sql_exact_sum('v')} FROM '{tmp_dir}/t/*.parquet' GROUP BY 1").fetchall())
    assert got == want


def test_bands_are_added_as_whole_numbers(spark):
    """Both halves of a band, of either sign, without decimals in the aggregation."""
    rng = random.Random(7)
    values = [rng.choice([-1, 1]) * rng.randrange(2 ** 56) * 2.0 ** rng.choice([-52, -20, 0, 40, 100]) for _ in range(4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(7).agg(exact_sum("v").alias("s"))
    want = float(sum(Fraction(v) for v in values))
    assert abs(df.collect()[0].s - want) <= abs(want) * 2 ** -50
    keys = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Aggregate" in x]
    assert keys and not any("partial_sum(cast" in x and "decimal" in x.split("partial_sum(", 1)[1] for x in keys)
