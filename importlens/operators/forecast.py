"""Demand forecast for host countries as one lazy plan.

Baseline demand per commodity is scaled by a target country's GDP factor
(its average GDP over the largest country average) and divided by the
average county capacity plus one. The scalars (max GDP with the targets'
averages, capacity) are scalar subqueries: each is a one-row aggregate that
Spark evaluates inside the plan, with no driver round trip and no cross
join. A target without GDP yields a NULL factor, not an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from importlens import config
from importlens.functions.columns import mean
from importlens.functions.exact import total
from importlens.operators.measures import country_slice


def baseline_demand(trade: DataFrame, iso3: str = config.BASELINE_ISO3) -> DataFrame:
    """Baseline country's total value per commodity code."""
    return (country_slice(trade, iso3).groupBy("commodity_code")
            .agg(total(trade, "trade_value").alias("qatar_demand")))


def gdp_averages(indicators: DataFrame, gdp_name: str = config.GDP_INDICATOR) -> DataFrame:
    """Average GDP per country over its non-null values."""
    return (indicators
            .filter((F.col("indicator_name") == F.lit(gdp_name)) & F.col("value").isNotNull())
            .groupBy("country_iso3").agg(mean(indicators, "value").alias("avg_gdp")))


def scaling_factor(indicators: DataFrame, gdp_name: str = config.GDP_INDICATOR) -> DataFrame:
    """``avg_gdp / max(avg_gdp)`` per country (``max`` is a scalar subquery)."""
    gdp = gdp_averages(indicators, gdp_name)
    gdp_max = gdp.agg(F.max("avg_gdp")).scalar()
    return gdp.withColumn("gdp_factor", F.try_divide(F.col("avg_gdp"), gdp_max))


def capacity(county: DataFrame) -> DataFrame:
    """Average employment over all county rows (one row, NULL when none)."""
    return county.agg(mean(county, "employment").alias("avg_employment"))


def factor_stats(indicators: DataFrame, targets: list[str],
                 gdp_name: str = config.GDP_INDICATOR) -> Column:
    """One scalar subquery: ``struct<max_gdp, avg_by_target: map<iso3, avg>>``.

    The map holds at most ``len(targets)`` entries (the caller's list).
    """
    gdp = gdp_averages(indicators, gdp_name)
    wanted = F.when(F.col("country_iso3").isin(list(targets)), F.struct("country_iso3", "avg_gdp"))
    return gdp.agg(F.struct(F.max("avg_gdp").alias("max_gdp"),
                            F.map_from_entries(F.collect_list(wanted)).alias("avg_by_target"))
                   .alias("s")).scalar()


def factors_from(stats: Column, targets: list[str]) -> Column:
    """``array<struct<target_iso3, gdp_factor>>`` from a ``factor_stats`` value."""
    return F.array(*[
        F.struct(F.lit(t).alias("target_iso3"),
                 F.try_divide(F.try_element_at(stats.getField("avg_by_target"), F.lit(t)),
                              stats.getField("max_gdp")).alias("gdp_factor"))
        for t in targets
    ])


def target_factors(indicators: DataFrame, targets: list[str],
                   gdp_name: str = config.GDP_INDICATOR) -> Column:
    """Factors of the given targets (NULL for a target without GDP), as one scalar."""
    return factors_from(factor_stats(indicators, targets, gdp_name), targets)


def predicted_demand(trade: DataFrame, indicators: DataFrame,
                     baseline: str = config.BASELINE_ISO3,
                     targets: list[str] | None = None,
                     gdp_name: str = config.GDP_INDICATOR) -> DataFrame:
    """Baseline demand scaled by each target's factor: one row per code and target.

    The targets are a short, caller-given list; all factors come from one
    scalar subquery and ride along as a target-sized array, so the demand
    side is computed once.
    """
    targets = list(targets or config.TARGET_ISO3)
    demand = baseline_demand(trade, baseline)
    # the scalar is projected once, then the per-target pairs are read from it
    with_stats = demand.select("commodity_code", "qatar_demand",
                               factor_stats(indicators, targets, gdp_name).alias("_s"))
    return (with_stats.select("commodity_code", "qatar_demand",
                              F.inline(factors_from(F.col("_s"), targets)))
            .withColumn("predicted_demand",
                        F.col("qatar_demand").cast("double") * F.col("gdp_factor"))
            .select("commodity_code", "target_iso3", "qatar_demand", "predicted_demand"))


def opportunity_score(predicted: DataFrame, county: DataFrame) -> DataFrame:
    """``predicted_demand / (average employment + 1)``; capacity is a scalar subquery."""
    cap = capacity(county).scalar()
    return predicted.withColumn(
        "opportunity_score", F.try_divide(F.col("predicted_demand"), cap + F.lit(1.0)))


def stocking_prediction_all(trade: DataFrame, indicators: DataFrame, county: DataFrame,
                            baseline: str = config.BASELINE_ISO3,
                            targets: list[str] | None = None,
                            gdp_name: str = config.GDP_INDICATOR) -> DataFrame:
    """Scores for every target: code, target, baseline, predicted demand, score."""
    return opportunity_score(
        predicted_demand(trade, indicators, baseline, targets, gdp_name), county)


def stocking_prediction(trade: DataFrame, indicators: DataFrame, county: DataFrame,
                        baseline: str = config.BASELINE_ISO3,
                        target: str = config.TARGET_ISO3[0],
                        gdp_name: str = config.GDP_INDICATOR) -> DataFrame:
    """The published single-target table: code, baseline demand, predicted demand, score."""
    return (stocking_prediction_all(trade, indicators, county, baseline, [target], gdp_name)
            .select("commodity_code", "qatar_demand", "predicted_demand", "opportunity_score"))
