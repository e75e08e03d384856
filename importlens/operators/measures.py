"""Trade and indicator measures (the published analysis tables).

Sums are exact for the measure's own type and do not depend on the order of the
rows (see ``functions.exact``); averages use ``mean`` (double). All groupings run as partial + final hash aggregates, so
a country holding a large share of the rows is pre-aggregated map-side
before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from importlens import config
from importlens.functions.columns import mean
from importlens.functions.exact import total


def exclude_rollup(trade: DataFrame, rollup_code: str = config.ROLLUP_CODE) -> DataFrame:
    """Drop roll-up rows; a NULL code is dropped as well (three-valued ``!=``)."""
    return trade.filter(F.col("commodity_code") != F.lit(rollup_code))


def country_slice(trade: DataFrame, iso3: str = config.BASELINE_ISO3) -> DataFrame:
    """One country's non-roll-up rows (both predicates reach the scan)."""
    return exclude_rollup(trade.filter(F.col("country_iso3") == F.lit(iso3)))


def rollup_summary(trade: DataFrame) -> DataFrame:
    """Per country: all rows, non-roll-up rows and their value."""
    keep = (F.col("commodity_code") != F.lit(config.ROLLUP_CODE))
    return trade.groupBy("country_iso3").agg(
        F.count(F.lit(1)).alias("rows_total"),
        F.count_if(keep).alias("rows_kept"),
        total(trade, "trade_value", F.when(keep, F.col("trade_value"))).alias("value_kept"),
    )


def top_commodities(trade: DataFrame, iso3: str = config.BASELINE_ISO3) -> DataFrame:
    """Total import value per (code, description) of one country."""
    return (country_slice(trade, iso3)
            .groupBy("commodity_code", "commodity_desc")
            .agg(total(trade, "trade_value").alias("total_import_value")))


def monthly_trend(trade: DataFrame, iso3: str = config.BASELINE_ISO3) -> DataFrame:
    """Import value per calendar month of one country."""
    return (country_slice(trade, iso3)
            .groupBy(F.year("month_date").alias("year"), F.month("month_date").alias("month"))
            .agg(total(trade, "trade_value").alias("monthly_import_value")))


def monthly_trend_by_country(trade: DataFrame) -> DataFrame:
    """Import value per country and calendar month (all countries)."""
    return (exclude_rollup(trade)
            .groupBy("country_iso3", F.year("month_date").alias("year"),
                     F.month("month_date").alias("month"))
            .agg(total(trade, "trade_value").alias("monthly_import_value")))


def indicator_trends(indicators: DataFrame) -> DataFrame:
    """Indicator rows that carry a value, in long form."""
    return (indicators.filter(F.col("value").isNotNull())
            .select("country_iso3", "country_name", "year", "indicator_name", "value"))


def indicator_slice(indicators: DataFrame, name: str) -> DataFrame:
    """One indicator's values by country and year."""
    return (indicator_trends(indicators)
            .filter(F.col("indicator_name") == F.lit(name))
            .select("country_iso3", "year", "value"))


def imports_by_year(trade: DataFrame) -> DataFrame:
    """Per country and year: total value and exact number of distinct codes."""
    return (exclude_rollup(trade)
            .groupBy("country_iso3", F.year("month_date").alias("year"))
            .agg(total(trade, "trade_value").alias("total_import_value"),
                 F.count_distinct("commodity_code").alias("distinct_commodities")))


def indicator_averages(indicators: DataFrame) -> DataFrame:
    """Average of every indicator per country over all its years."""
    return (indicator_trends(indicators)
            .groupBy("country_iso3", "country_name", "indicator_name")
            .agg(mean(indicators, "value").alias("average_indicator_value")))


def indicator_pivot(indicators: DataFrame, names: list[str] = config.INDICATOR_NAMES,
                    keys: tuple[str, ...] = ("country_iso3", "country_name")) -> DataFrame:
    """One column per indicator holding its average per key.

    The value list is given, so no discovery job runs, the column set is
    fixed (absent indicators become NULL columns), and the same list filters
    the scan. Averaging straight from the rows equals averaging the
    per-indicator averages, since each cell holds one average.
    """
    rows = indicator_trends(indicators).filter(F.col("indicator_name").isin(list(names)))
    return rows.groupBy(*keys).pivot("indicator_name", list(names)).agg(mean(indicators, "value"))


def import_summary(trade: DataFrame) -> DataFrame:
    """Per country: total, average row value and distinct codes."""
    return (exclude_rollup(trade)
            .groupBy("country_iso3")
            .agg(total(trade, "trade_value").alias("total_import_value"),
                 mean(trade, "trade_value").alias("average_transaction_value"),
                 F.count_distinct("commodity_code").alias("distinct_commodities")))


def host_comparison(trade: DataFrame, indicators: DataFrame,
                    names: list[str] = config.INDICATOR_NAMES) -> DataFrame:
    """Indicator averages side by side with the import summary.

    Left join: countries with indicators but no trade keep NULL import
    columns. Both sides are one row per country after aggregation; adaptive
    execution broadcasts the smaller one at run time from its measured size.
    """
    wide = indicator_pivot(indicators, names)
    return wide.join(import_summary(trade), "country_iso3", "left")


def country_imports(yearly: DataFrame) -> DataFrame:
    """Total import value per country from the country-year table."""
    return (yearly.groupBy("country_iso3")
            .agg(total(yearly, "total_import_value").alias("total_import_value")))
