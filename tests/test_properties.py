"""Column helpers and the histogram against plain-Python / numpy references.

Each property evaluates a whole generated batch in one Spark job.
"""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from importlens import config
from importlens.functions.columns import commodity_label_key, strict_number, zfill
from importlens.operators.report import histogram, with_commodity_label

TEXT = st.text(alphabet="0123456789+-. eED", max_size=8)


def _eval(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.v for r in df.select("i", expr(F.col("s")).alias("v")).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-ab", max_size=6), min_size=1, max_size=200),
       st.integers(min_value=1, max_value=5))
def test_zfill_matches_python(spark, values, width):
    assert _eval(spark, values, lambda c: zfill(c, width)) == [v.zfill(width) for v in values]


def _to_numeric(v):
    out = pd.to_numeric(pd.Series([v], dtype=object), errors="coerce").iloc[0]
    return None if pd.isna(out) else float(out)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=200))
def test_strict_number_matches_coercing_parser(spark, values):
    got = _eval(spark, values, lambda c: strict_number(c))
    want = [_to_numeric(v) for v in values]
    assert got == want


def _label(code):
    cleaned = code.replace(".0", "").strip()
    return config.HS2_LABELS.get(cleaned[:2].zfill(2), f"Commodity {cleaned}")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789. TOAL", max_size=7), min_size=1, max_size=200))
def test_label_matches_rule(spark, codes):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, commodity_code string")
    got = [r.commodity_label for r in with_commodity_label(df).orderBy("i").collect()]
    assert got == [_label(c) for c in codes]


def test_label_key_parts(spark):
    df = spark.createDataFrame([(" 1.0 ",)], "c string")
    cleaned, key = commodity_label_key("c")
    r = df.select(cleaned.alias("a"), key.alias("b")).collect()[0]
    assert (r.a, r.b) == ("1", "01")


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(7)
    for n_bins, values in ((20, rng.normal(100, 30, 997)), (30, rng.exponential(5, 1500)),
                           (7, rng.uniform(-1, 1, 50))):
        df = spark.createDataFrame([(float(v),) for v in values], "opportunity_score double")
        got = [r["count"] for r in histogram(df, "opportunity_score", n_bins).orderBy("bin").collect()]
        want, edges = np.histogram(values, bins=n_bins)
        assert got == [int(x) for x in want]
        lows = [r.lower for r in histogram(df, "opportunity_score", n_bins).orderBy("bin").collect()]
        assert np.allclose(lows, edges[:-1])


def test_growth_matches_pandas_pct_change(spark):
    from importlens.operators.report import monthly_growth
    from importlens.plans import inputs
    from importlens.operators.measures import monthly_trend
    trend = monthly_trend(inputs.trade(spark, "/root/testdata/sf0.01"), "NATION_1")
    got = monthly_growth(trend).orderBy("date").toPandas()
    series = got["monthly_import_value"].astype(float)
    want = series.pct_change() * 100
    assert got["growth_rate"].isna().iloc[0] and want.isna().iloc[0]
    assert np.allclose(got["growth_rate"].iloc[1:].astype(float), want.iloc[1:], rtol=1e-12)
