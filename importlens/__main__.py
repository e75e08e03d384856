"""Command line.

``python -m importlens run --trade QAT=path ... --indicators f --county f --out dir``
``python -m importlens dashboard --out dir [--year 2022 ...] [--country USA ...]``
``python -m importlens check --out dir``
``python -m importlens export --out dir --to dir``
``python -m importlens publish-jdbc --out dir --url jdbc:... [--property user=...]``

The master, shuffle partitions and the shared folder come from ``spark-submit``
or the Spark defaults; ``--master``, ``--shuffle-partitions`` and ``--work-dir``
set them for a run without those.
"""

from __future__ import annotations

import argparse
import json

from importlens import config, dims
from importlens.plans import jobs
from importlens.session import build_session


def _parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--out", required=True, help="folder of the cleaned and published tables")
    common.add_argument("--master")
    common.add_argument("--shuffle-partitions", type=int)
    common.add_argument("--work-dir", help="shared folder for spark.checkpoint.dir")
    ap = argparse.ArgumentParser(prog="importlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", parents=[common], help="clean landed files and publish the result tables")
    run.add_argument("--trade", action="append", required=True, metavar="ISO3=PATH")
    run.add_argument("--indicators", required=True)
    run.add_argument("--indicators-json", action="store_true", help="indicators landed as JSON lines of responses")
    run.add_argument("--county", action="append", required=True)
    run.add_argument("--one-layout", action="store_true", help="read all trade exports in one tagged scan")
    dash = sub.add_parser("dashboard", parents=[common], help="write the dashboard data sets from published tables")
    dash.add_argument("--year", action="append", type=int)
    dash.add_argument("--country", action="append")
    dash.add_argument("--indicator")
    chk = sub.add_parser("check", parents=[common], help="row counts, distinct codes and missing months of the cleaned tables")
    chk.add_argument("--events", help="event calendar CSV, checked for readable rows")
    exp = sub.add_parser("export", parents=[common], help="export the published tables as CSV")
    exp.add_argument("--to", required=True)
    jdbc = sub.add_parser("publish-jdbc", parents=[common], help="overwrite a database table per published table")
    jdbc.add_argument("--url", required=True)
    jdbc.add_argument("--property", action="append", default=[], metavar="NAME=VALUE")
    return ap


def _check(spark, args) -> dict:
    base = args.out.rstrip("/") + "/clean"
    cleaned = jobs.Cleaned(*(spark.read.parquet(f"{base}/{t}") for t in ("comtrade_clean", "worldbank_clean", "cbp_clean")))
    checks = jobs.data_check(cleaned)
    if args.events:
        checks["events"] = dims.event_calendar(spark, args.events)
    written = {}
    for name, df in checks.items():     # every check result is written whole
        written[name] = f"{args.out.rstrip('/')}/check/{name}"
        df.write.mode("overwrite").parquet(written[name])
    back = {name: spark.read.parquet(path) for name, path in written.items()}
    # the counts table has one row per cleaned table (three rows); the grids are configuration-sized
    out = {"counts": [r.asDict() for r in back["counts"].collect()], "distinct_codes": back["distinct_codes"].count()}
    out["missing_months"] = [f"{r.country_iso3} {r.period}" for r in
                             back["period_coverage"].where("missing").orderBy("country_iso3", "period").collect()]
    out["missing_indicator_cells"] = back["indicator_coverage"].where("missing").count()
    if args.events:
        out["events"] = back["events"].where("event_start IS NOT NULL").count()
    return out | {"written": written}


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(args.master, args.shuffle_partitions,
                          extra={"spark.checkpoint.dir": args.work_dir} if args.work_dir else None)
    if args.cmd == "run":
        trade = dict(t.split("=", 1) for t in args.trade)
        out = jobs.run(spark, trade, args.indicators, args.county, args.out, one_layout=args.one_layout,
                       indicators_json=args.indicators_json)
    elif args.cmd == "dashboard":
        tables = jobs.dashboard_tables(jobs.read_published(spark, args.out), years=args.year, countries=args.country,
                                       indicator=args.indicator or config.GDP_INDICATOR)
        out = jobs.write_dashboards(tables, args.out)
    elif args.cmd == "export":
        out = jobs.export_all(spark, args.out, args.to)
    elif args.cmd == "publish-jdbc":
        out = jobs.publish_jdbc(jobs.read_published(spark, args.out), args.url,
                                dict(p.split("=", 1) for p in args.property))
    else:
        out = _check(spark, args)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
