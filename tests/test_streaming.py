"""Incremental ingest: new files only, exactly once across restarts."""

import os

from importlens.streaming.ingest import start_trade_ingest
from tests.conftest import write_text

HEADER = ["cmdCode", "cmdDesc", "primaryValue", "period"]


def test_incremental_ingest_exactly_once(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    out, ckpt = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "ckpt")
    write_text(landing, "202201.csv", "cmdCode,cmdDesc,primaryValue,period\n01,a,10,202201\n02,b,N/A,202201\n")
    write_text(landing, "202202.csv", "cmdCode,cmdDesc,primaryValue,period\n01,a,5,202202\n")
    q = start_trade_ingest(spark, landing, out, ckpt, HEADER, iso3="QAT")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2

    # a restart with no new file adds nothing; a new file is added once
    q = start_trade_ingest(spark, landing, out, ckpt, HEADER, iso3="QAT")
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    write_text(landing, "202203.csv", "cmdCode,cmdDesc,primaryValue,period\n03,c,7,202203\n04,d,1,202213\n")
    q = start_trade_ingest(spark, landing, out, ckpt, HEADER, iso3="QAT")
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.commodity_code for r in rows) == ["01", "01", "03"]
    assert {r.country_iso3 for r in rows} == {"QAT"}
