"""Registered queries: SQL where there is any, native plans, and tables that lack rows."""

import os

import pytest

from importlens.llm import license_scan, registry
from importlens.llm.common import table
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = registry.queries()[name](spark, SF)
    found = con.execute(registry.oracle_sql()[name])
    rows = found.fetchall()
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in found.description], rows)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert all(isinstance(sql, str) for sql in registry.oracle_sql().values())


@pytest.mark.parametrize("name", ["op1_license_scan", "op6_decontaminate", "op11_chat_format"])
def test_native_plans(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas", "CartesianProduct"):
        assert bad not in plan


def test_every_document_once(spark):
    docs = table(spark, SF, "documents").count()
    for name in ("op3_quality", "op5_sentencepiece", "op8_line_dedup", "op9_simhash_dedup", "op10_language_id", "op13_merkle_manifest"):
        assert registry.queries()[name](spark, SF).count() == docs, name
    assert license_scan.known_licenses(spark).count() > 10
