"""Every catalog query against its SQL oracle, and plan-shape checks."""

import os

import pytest

import __spark_entry__ as E
from importlens.plans import catalog
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.oracle_sql()) <= set(E.oracle_sql())
    assert len(catalog.queries()) >= 50
    assert all(isinstance(sql, str) for sql in E.oracle_sql().values())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert canon(df.columns, srows) == canon(dcols, drows)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_is_native(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad} in plan"


@pytest.mark.parametrize("name", ["topk_commodities", "topk_predictions", "topk_labels"])
def test_topk_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in _plan(E.queries()[name](spark, SF))


@pytest.mark.parametrize("name", ["top_commodities", "monthly_trend", "baseline_demand"])
def test_baseline_queries_prune_country_partitions(spark, name):
    df = E.queries()[name](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(country_iso3" in text and "NATION_1" in text


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["commodity_code", "qatar_demand", "predicted_demand", "opportunity_score"]
    assert df.count() >= 0
