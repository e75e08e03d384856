"""Cleaned inputs over the fixture views, shared by every catalog query.

Each is a written stage (see ``stages``): raw landing, then cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from importlens import dims
from importlens.operators.clean import clean_county, clean_indicators, clean_trade, extract_county
from importlens.plans import fixtures as fx
from importlens.plans.stages import materialized


def trade_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed export (text columns), written once, one folder per country.

    As exports land per country, reads of one country's pull prune to its folder.
    The rows are dealt by country while they are narrow.
    """
    return materialized(spark, sf_dir, "trade_raw", lambda: fx.trade_raw(spark, sf_dir, rebalance=True),
                        partition_by=["country_iso3"], rebalance=False)


def trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trade fact, partitioned by country.

    Cleaned from the written landing stage, so the raw joins run once. A split
    may hold small files of several countries, so the rows are rebalanced by
    country before the partitioned write; a large country is split over tasks.
    """
    return materialized(spark, sf_dir, "trade_clean",
                        lambda: clean_trade(trade_raw(spark, sf_dir).drop("region_key"), fx.MEASURE),
                        partition_by=["country_iso3"])


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialized(spark, sf_dir, "indicators",
                        lambda: clean_indicators(fx.indicator_raw(spark, sf_dir), fx.MEASURE))


def county(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        hosts = dims.host_counties(spark, fx.host_county_rows())
        extracted = extract_county(fx.county_raw(spark, sf_dir), hosts, dims.naics_sectors(spark),
                                   fx.MEASURE)
        return clean_county(extracted, fx.MEASURE)
    return materialized(spark, sf_dir, "county", build)


def indicator_dim(spark: SparkSession) -> DataFrame:
    return dims.indicators(spark, dict(fx.indicator_dim_rows()))


def result(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the six published result tables, written once.

    Dashboard data sets read these (as the dashboards read the published
    tables), so top-N, histograms and KPIs never touch the trade fact.
    """
    from importlens.plans.jobs import Cleaned, result_tables

    def build() -> DataFrame:
        cleaned = Cleaned(trade(spark, sf_dir), indicators(spark, sf_dir), county(spark, sf_dir))
        return result_tables(cleaned, fx.BASELINE, fx.TARGET, fx.INDICATOR_NAMES, fx.GDP,
                             sort=False)[name]
    return materialized(spark, sf_dir, f"result_{name}", build)


def results(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six published tables, written concurrently."""
    from importlens.plans.jobs import RESULT_TABLES
    from importlens.plans.stages import build_concurrently
    return build_concurrently(spark, {name: (lambda n=name: result(spark, sf_dir, n))
                                      for name in RESULT_TABLES})


def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three cleaned inputs, written concurrently."""
    from importlens.plans.stages import build_concurrently
    return build_concurrently(spark, {"trade": lambda: trade(spark, sf_dir),
                               "indicators": lambda: indicators(spark, sf_dir),
                               "county": lambda: county(spark, sf_dir)})
