"""End-to-end batch job: landed files -> clean stage -> published tables.

* ``load_landed``     reads the landed trade files (one per country, each with
                      its own header), the indicator rows and county files;
* ``write_clean``     writes the three cleaned tables as Parquet (trade
                      partitioned by country) and returns readers over them;
* ``result_tables``   the six published tables, ordered for presentation;
* ``publish``         writes them (each evaluated once: Parquet, then CSV from
                      that copy; or a database table through JDBC);
* ``export_all``      writes an existing published set as CSV;
* ``data_check``      row counts, distinct codes, sample rows, and the planned
                      months and indicator cells that did not land.

Every step is a Spark write or a lazy plan; nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens import config, dims, schemas
from importlens.operators import coverage, forecast, measures, report
from importlens.operators.clean import clean_county, clean_indicators, clean_trade, extract_county
from importlens.operators.harmonize import union_all_by_name
from importlens.plans.publishing import publish_set, read_set
from importlens.sinks.files import write_csv, write_jdbc, write_parquet, write_single_csv
from importlens.sources.files import read_csv_strings, read_tagged
from importlens.sources.indicators import flatten_indicator_payloads

RESULT_TABLES = [
    "commodity_surges_qatar",
    "qatar_monthly_import_trend",
    "worldbank_indicator_trends",
    "import_by_country_year",
    "host_country_comparison",
    "predicted_stocking_opportunities",
]


#: Presentation order of the published tables (equal measures by key); a minus means descending.
ORDER = {
    "commodity_surges_qatar": ["-total_import_value", "commodity_code", "commodity_desc"],
    "qatar_monthly_import_trend": ["year", "month"],
    "import_by_country_year": ["country_iso3", "year"],
    "host_country_comparison": ["country_iso3", "country_name"],
    "predicted_stocking_opportunities": ["-opportunity_score", "commodity_code"],
}


def presented(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the presentation order of the published table ``name``, if it has one."""
    keys = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDER.get(name, [])]
    return df.orderBy(*keys) if keys else df


def positioned(df: DataFrame, name: str) -> DataFrame:
    """``df`` with its row numbers in the presentation order of the published table ``name``."""
    keys = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDER[name]]
    return report.with_position(df, keys)


@dataclass
class Cleaned:
    trade: DataFrame
    indicators: DataFrame
    county: DataFrame


def load_landed(spark: SparkSession, trade_paths: Mapping[str, str], indicators_path: str | list[str],
                county_paths: list[str], measure_type: str = "double",
                one_layout: bool = False, indicators_json: bool = False,
                years: list[int] | None = None) -> Cleaned:
    """Read and clean the landed files (only their headers are read yet).

    ``indicators_json``: the indicators landed as JSON lines with the request's
    ``country_iso3`` and ``indicator_code`` and the response text ``payload``
    (items outside ``years`` are dropped); otherwise as CSV rows.

    By default each country's export is read on its own, so each may have
    its own header layout. With ``one_layout`` (all exports share a header)
    every country is read in one tagged scan, which keeps the plan one scan
    wide however many countries there are.
    """
    if one_layout:
        landed = read_tagged(spark, dict(trade_paths), tag="country_iso3")
        trade = clean_trade(landed, measure_type)
    else:
        trade = clean_trade({iso: read_csv_strings(spark, p) for iso, p in trade_paths.items()},
                            measure_type)
    if indicators_json:
        landed = spark.read.schema(schemas.INDICATOR_PAYLOADS).json(indicators_path)
        rows = flatten_indicator_payloads(landed, dims.indicators(spark), years or config.YEARS["worldbank"])
    else:
        rows = read_csv_strings(spark, indicators_path)
    indicators = clean_indicators(rows, measure_type)
    hosts, sectors = dims.host_counties(spark), dims.naics_sectors(spark)
    county = clean_county(union_all_by_name(
        [extract_county(read_csv_strings(spark, p), hosts, sectors, measure_type) for p in county_paths]),
        measure_type)
    return Cleaned(trade, indicators, county)


def write_clean(cleaned: Cleaned, out_dir: str) -> Cleaned:
    """Write the cleaned tables (the stage boundary) and read them back.

    The trade rows are dealt by country before the partitioned write (bounded
    files per country, a large country split over many tasks): a file may hold
    rows of several countries, and a read split may hold several files.
    """
    spark = cleaned.trade.sparkSession
    trade = cleaned.trade.hint("rebalance", "country_iso3")
    paths = {
        "comtrade_clean": (trade, ["country_iso3"]),
        "worldbank_clean": (cleaned.indicators, None),
        "cbp_clean": (cleaned.county, None),
    }
    readers = {}
    for name, (df, part) in paths.items():
        path = f"{out_dir.rstrip('/')}/clean/{name}"
        write_parquet(df, path, partition_by=part)
        readers[name] = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    return Cleaned(readers["comtrade_clean"], readers["worldbank_clean"], readers["cbp_clean"])


def result_tables(c: Cleaned, baseline: str = config.BASELINE_ISO3, target: str = config.TARGET_ISO3[0],
                  indicator_names: list[str] = config.INDICATOR_NAMES,
                  gdp_name: str = config.GDP_INDICATOR, sort: bool = True) -> dict[str, DataFrame]:
    """The six published tables (in presentation order when ``sort``)."""
    tables = {
        "commodity_surges_qatar": measures.top_commodities(c.trade, baseline),
        "qatar_monthly_import_trend": measures.monthly_trend(c.trade, baseline),
        "worldbank_indicator_trends": measures.indicator_trends(c.indicators),
        "import_by_country_year": measures.imports_by_year(c.trade),
        "host_country_comparison": measures.host_comparison(c.trade, c.indicators, indicator_names),
        "predicted_stocking_opportunities": forecast.stocking_prediction(
            c.trade, c.indicators, c.county, baseline, target, gdp_name),
    }
    if not sort:
        return tables
    return {name: presented(df, name) for name, df in tables.items()}


#: Published tables that are no aggregates: their CSV keeps one file per task.
UNBOUNDED = {"worldbank_indicator_trends"}


def publish(tables: Mapping[str, DataFrame], out_dir: str, csv: bool = True) -> dict[str, str]:
    """Publish the result tables as one set: Parquet, plus header CSV from that copy when ``csv``.

    Every table is evaluated once; independent tables are written side by side. Readers
    see the whole set or the one before (see ``plans.publishing``).
    """
    def write(name: str, df: DataFrame, base: str) -> None:
        write_parquet(df, base + "/parquet")
        if csv:
            _export(df.sparkSession.read.parquet(base + "/parquet"), name, base + "/csv")

    return publish_set(tables, out_dir, write)


def _export(df: DataFrame, name: str, path: str) -> str:
    """CSV of a published table: one file, in the published order, for aggregates."""
    if name in UNBOUNDED:
        return write_csv(df, path)
    return write_single_csv(presented(df, name), path)


def export_all(spark: SparkSession, published_dir: str, export_dir: str) -> dict[str, str]:
    """Export every table published under ``published_dir`` as header CSV, without computing it again."""
    tables = read_published(spark, published_dir)
    return {name: _export(df, name, f"{export_dir.rstrip('/')}/{name}") for name, df in tables.items()}


def publish_jdbc(tables: Mapping[str, DataFrame], url: str, properties: dict | None = None) -> list[str]:
    """Overwrite one database table per result (the database is the caller's)."""
    for name, df in tables.items():
        write_jdbc(df, url, name, properties)
    return list(tables)


def data_check(c: Cleaned, sample: int = 5, pull_plan: dict[str, list[int]] | None = None) -> dict[str, DataFrame]:
    """Row counts (and non-roll-up trade rows), distinct codes, sample rows, and coverage.

    ``period_coverage`` has a row for each planned country and month (the
    configured pull plan by default), ``indicator_coverage`` one for each
    planned country, indicator and year; ``missing`` marks what did not land.
    """
    plan = pull_plan or config.trade_pull_plan()
    months = c.trade.select("country_iso3", F.date_format("month_date", "yyyyMM").alias("period"))
    return {
        "period_coverage": coverage.period_coverage(months, plan),
        "indicator_coverage": coverage.indicator_coverage(
            c.indicators, sorted(plan), config.INDICATOR_NAMES, config.YEARS["worldbank"]),
        "counts": report.row_profile(
            {"comtrade_clean": c.trade, "worldbank_clean": c.indicators, "cbp_clean": c.county},
            kept={"comtrade_clean": F.col("commodity_code") != F.lit(config.ROLLUP_CODE)}),
        "distinct_codes": report.distinct_values(c.trade, "commodity_code"),
        "trade_sample": report.sample_rows(c.trade, sample),
        "indicator_sample": report.sample_rows(c.indicators, sample),
        "county_sample": report.sample_rows(c.county, sample),
    }


def label_predictions(predictions: DataFrame) -> DataFrame:
    """Score, predicted and baseline demand of the published predictions, summed per label."""
    return report.totals_by_label(report.with_commodity_label(predictions),
                                  ["opportunity_score", "predicted_demand", "qatar_demand"])


def dashboard_tables(published: Mapping[str, DataFrame], years: list[int] | None = None,
                     countries: list[str] | None = None, indicator: str = config.GDP_INDICATOR,
                     indicator_names: list[str] = config.INDICATOR_NAMES,
                     top_labels: int = 10, top_predictions: int = 10) -> dict[str, DataFrame]:
    """Every dashboard data set, computed from the six published tables.

    ``years`` / ``countries`` are the selectors (all when None); growth is
    computed on the full monthly series before the year selection.
    """
    trend = published["qatar_monthly_import_trend"]
    growth = report.monthly_growth(trend)
    trend_sel = report.select_years(trend, years) if years else trend
    growth_sel = report.select_years(growth, years) if years else growth
    commodities = report.with_commodity_label(published["commodity_surges_qatar"])
    top10 = report.top_n(commodities, "total_import_value", 10, ["commodity_code", "commodity_desc"])
    labels = report.top_n(report.totals_by_label(commodities, ["total_import_value"]),
                          "total_import_value", top_labels, ["commodity_label"])
    host = published["host_country_comparison"]
    yearly = published["import_by_country_year"]
    trends = published["worldbank_indicator_trends"]
    if countries:
        host, yearly, trends = (report.select_countries(df, countries) for df in (host, yearly, trends))
    pred = report.with_commodity_label(published["predicted_stocking_opportunities"])
    by_label = label_predictions(published["predicted_stocking_opportunities"])
    return {
        "monthly_growth": growth_sel,
        "trend_kpis": report.kpi_trend(trend_sel),
        "top_commodities": top10,
        "top_commodity_share": report.share_of_total(top10, "total_import_value"),
        "top_labels": labels,
        "top_label_share": report.share_of_total(labels, "total_import_value"),
        "country_imports": measures.country_imports(published["import_by_country_year"]),
        "imports_by_year_selected": yearly,
        "hosts_selected": host,
        "host_kpis": report.kpi_hosts(host),
        "indicator_pivot_by_country": measures.indicator_pivot(trends, indicator_names, keys=("country_iso3",)),
        "indicator_selected": measures.indicator_slice(trends, indicator),
        "top_predictions": report.top_n(pred, "opportunity_score", 10, ["commodity_code"]),
        "score_histogram": report.histogram(pred, "opportunity_score", 20),
        "demand_pairs": pred.select("commodity_code", "commodity_label", "qatar_demand", "predicted_demand"),
        "predictions_by_label": by_label,
        "top_predictions_by_label": report.top_n(by_label, "opportunity_score", top_predictions,
                                                 ["commodity_label"]),
        "label_score_histogram": report.histogram(by_label, "opportunity_score", 30),
        "prediction_kpis": report.kpi_predictions(pred, by_label),
    }


def read_published(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Readers over the Parquet copies of the set that ``publish`` published last."""
    return read_set(spark, out_dir, RESULT_TABLES)


def write_dashboards(tables: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each dashboard data set as one Parquet folder."""
    return {name: _write_dashboard(df, f"{out_dir.rstrip('/')}/dashboards/{name}") for name, df in tables.items()}


def _write_dashboard(df: DataFrame, path: str) -> str:
    write_parquet(df, path)
    return path


def run(spark: SparkSession, trade_paths: Mapping[str, str], indicators_path: str | list[str],
        county_paths: list[str], out_dir: str, one_layout: bool = False, indicators_json: bool = False,
        **params) -> dict[str, str]:
    """Clean, write the stage, compute and publish the six tables."""
    landed = load_landed(spark, trade_paths, indicators_path, county_paths, one_layout=one_layout,
                         indicators_json=indicators_json)
    cleaned = write_clean(landed, out_dir)
    return publish(result_tables(cleaned, **params), out_dir)
