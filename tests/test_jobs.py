"""The end-to-end job on hand-made landed files."""

import os

from importlens.plans import jobs
from tests.conftest import write_text


def _landed(tmp):
    q = write_text(tmp, "comtrade_QAT.csv",
                   "cmdCode,cmdDesc,primaryValue,cifvalue,period\n"
                   "01,Live animals,100,90,202201\n02,Meat,50,1,202202\nTOTAL,All,999,1,202201\n"
                   "03,Fish,N/A,1,202203\n")
    u = write_text(tmp, "comtrade_USA.csv",
                   "cmdCode,TradeValue,extract_period\n01,10,202301\n02,20,202302\n")
    w = write_text(tmp, "worldbank.csv",
                   "country_iso3,country_name,year,indicator_code,indicator_name,value\n"
                   "QAT,Qatar,2022,NY.GDP.PCAP.CD,gdp_per_capita,50\n"
                   "USA,United States,2022,NY.GDP.PCAP.CD,gdp_per_capita,100\n"
                   "USA,United States,2023,NY.GDP.PCAP.CD,gdp_per_capita,\n"
                   "USA,United States,2022,SP.POP.TOTL,population,330\n")
    c = write_text(tmp, "cbp.txt", "fipstate,fipscty,naics,est,emp,ap\n06,037,44----,3,9,10\n36,061,72----,1,D,1\n")
    return {"QAT": q, "USA": u}, w, [c]


def test_run_publishes_six_tables(spark, tmp_dir):
    trade, wb, cbp = _landed(tmp_dir)
    out = jobs.run(spark, trade, wb, cbp, tmp_dir)
    assert list(out) == jobs.RESULT_TABLES
    pred = spark.read.parquet(out["predicted_stocking_opportunities"] + "/parquet").collect()
    rows = {r.commodity_code: r for r in pred}
    assert set(rows) == {"01", "02"}
    assert rows["01"].qatar_demand == 100.0 and rows["01"].predicted_demand == 100.0
    assert rows["01"].opportunity_score == 10.0        # capacity 9 -> /(9 + 1)
    csvs = [f for f in os.listdir(out["commodity_surges_qatar"] + "/csv") if f.endswith(".csv")]
    assert len(csvs) == 1
    host = {r.country_iso3: r for r in spark.read.parquet(out["host_country_comparison"] + "/parquet").collect()}
    assert host["USA"].gdp_per_capita == 100.0 and host["USA"].population == 330.0
    assert host["USA"].total_import_value == 30.0 and host["QAT"].distinct_commodities == 2


def test_data_check(spark, tmp_dir):
    trade, wb, cbp = _landed(tmp_dir)
    checks = jobs.data_check(jobs.load_landed(spark, trade, wb, cbp))
    counts = {r.table_name: (r.row_count, r.kept_count) for r in checks["counts"].collect()}
    assert counts["comtrade_clean"] == (5, 4) and counts["cbp_clean"] == (2, 2)
    assert checks["trade_sample"].count() <= 5
    assert {r.commodity_code for r in checks["distinct_codes"].collect()} == {"01", "02", "TOTAL"}


def test_cli_run(spark, tmp_dir):
    import json
    import subprocess
    import sys
    trade, wb, cbp = _landed(tmp_dir)
    out = os.path.join(tmp_dir, "cli-out")
    args = [sys.executable, "-m", "importlens", "run", "--master", "local[2]",
            "--trade", f"QAT={trade['QAT']}", "--trade", f"USA={trade['USA']}",
            "--indicators", wb, "--county", cbp[0], "--out", out]
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    res = subprocess.run(args, capture_output=True, text=True, timeout=300, env=env)
    assert res.returncode == 0, res.stderr[-2000:]
    published = json.loads(res.stdout.strip().splitlines()[-1])
    assert sorted(published) == sorted(jobs.RESULT_TABLES)
    assert os.path.isdir(os.path.join(out, "clean", "comtrade_clean", "country_iso3=QAT"))


def test_dashboard_tables(spark, tmp_dir):
    trade, wb, cbp = _landed(tmp_dir)
    jobs.run(spark, trade, wb, cbp, tmp_dir)
    published = jobs.read_published(spark, tmp_dir)
    dash = jobs.dashboard_tables(published, years=[2022], countries=["USA", "QAT"])
    assert {r.commodity_label for r in dash["top_labels"].collect()} == {"Live Animals", "Meat"}
    k = dash["trend_kpis"].collect()[0]
    assert k.total_import_value == 150.0 and k.peak_monthly_import == 100.0
    assert dash["host_kpis"].collect()[0].highest_import_country == "QAT"
    hist = dash["score_histogram"].collect()
    assert len(hist) == 20 and sum(r["count"] for r in hist) == 2
    shares = [r.share for r in dash["top_commodity_share"].collect()]
    assert abs(sum(shares) - 1.0) < 1e-12
    written = jobs.write_dashboards(dash, tmp_dir)
    assert spark.read.parquet(written["prediction_kpis"]).count() == 1


def test_cli_check(spark, tmp_dir):
    import json
    import subprocess
    import sys
    trade, wb, cbp = _landed(tmp_dir)
    jobs.run(spark, trade, wb, cbp, tmp_dir)
    env = dict(os.environ, PYTHONPATH=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    res = subprocess.run([sys.executable, "-m", "importlens", "check", "--master", "local[2]", "--out", tmp_dir],
                         capture_output=True, text=True, timeout=300, env=env)
    assert res.returncode == 0, res.stderr[-2000:]
    out = json.loads(res.stdout.strip().splitlines()[-1])
    assert out["distinct_codes"] == 3
    assert {c["table_name"]: c["row_count"] for c in out["counts"]}["comtrade_clean"] == 5


def test_one_layout_single_scan_matches_per_country_reads(spark, tmp_dir):
    _, wb, cbp = _landed(tmp_dir)
    same = os.path.join(tmp_dir, "one-layout")
    os.makedirs(same)
    header = "cmdCode,cmdDesc,primaryValue,period\n"
    q = write_text(same, "comtrade_QAT.csv", header + "01,a,100,202201\n02,b,50,202202\n")
    u = write_text(same, "comtrade_USA.csv", header + "01,a,10,202301\n")
    paths = {"QAT": q, "USA": u}
    per_country = jobs.load_landed(spark, paths, wb, cbp).trade
    one_scan = jobs.load_landed(spark, paths, wb, cbp, one_layout=True).trade
    cols = ["country_iso3", "commodity_code", "trade_value", "month_date"]
    assert sorted(one_scan.select(cols).collect()) == sorted(per_country.select(cols).collect())
    plan = one_scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
