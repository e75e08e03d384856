"""Expected-versus-landed coverage of the pulls.

The expected grid is configuration-sized (countries x years x months, or
countries x indicators x years); it is built with ``explode(sequence)`` and
left-joined to the landed rows aggregated per cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.dims import local_table


def period_grid(spark: SparkSession, pull_plan: dict[str, list[int]]) -> DataFrame:
    """``country_iso3, year, month, period`` for every planned month (``YYYYMM``)."""
    rows = [(iso3, y) for iso3, years in pull_plan.items() for y in years]
    plan = local_table(spark, rows, "country_iso3 string, year int")
    return (plan
            .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
            .withColumn("period", F.format_string("%d%02d", "year", "month")))


def period_coverage(trade: DataFrame, pull_plan: dict[str, list[int]]) -> DataFrame:
    """Rows landed per planned country-month; ``missing`` when none landed.

    ``trade`` is harmonised raw trade carrying ``country_iso3`` and the raw
    ``period`` text.
    """
    spark = trade.sparkSession
    landed = (trade.groupBy("country_iso3", F.col("period").cast("string").alias("period"))
              .agg(F.count(F.lit(1)).alias("rows_landed")))
    grid = period_grid(spark, pull_plan)
    return (grid.join(landed, ["country_iso3", "period"], "left")
            .select("country_iso3", "year", "month", "period",
                    F.coalesce("rows_landed", F.lit(0)).cast("long").alias("rows_landed"),
                    F.col("rows_landed").isNull().alias("missing")))


def indicator_coverage(indicators: DataFrame, countries: list[str], names: list[str],
                       years: list[int]) -> DataFrame:
    """Non-null values per country x indicator x year; ``missing`` when none."""
    spark = indicators.sparkSession
    grid = (local_table(spark, [(c,) for c in countries], "country_iso3 string")
            .withColumn("indicator_name", F.explode(F.array(*[F.lit(n) for n in names])))
            .withColumn("year", F.explode(F.array(*[F.lit(int(y)) for y in years]))))
    landed = (indicators.groupBy("country_iso3", "indicator_name", "year")
              .agg(F.count(F.lit(1)).alias("rows_landed"), F.count("value").alias("values_present")))
    return (grid.join(landed, ["country_iso3", "indicator_name", "year"], "left")
            .select("country_iso3", "indicator_name", "year",
                    F.coalesce("rows_landed", F.lit(0)).cast("long").alias("rows_landed"),
                    F.coalesce("values_present", F.lit(0)).cast("long").alias("values_present"),
                    (F.coalesce(F.col("values_present"), F.lit(0)) == 0).alias("missing")))
