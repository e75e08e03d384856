"""Dashboard data sets: labels, growth, top-N, shares, histograms, KPIs.

Inputs here are already aggregated (one row per month, commodity, label or
country). Series and total orders are dealt by range (``operators.order``);
the one whole-table window left is the total of a top-N set.
Operators that take a scalar from a whole table (histogram bounds) use a
scalar subquery, which stays correct on tables of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from importlens import dims
from importlens.dims import local_table
from importlens.operators.joins import broadcast_if_small
from importlens.functions.columns import commodity_label_key, mean, pct_change
from importlens.functions.exact import total
from importlens.operators import order


# ---------------------------------------------------------------- labels ----

def with_commodity_label(df: DataFrame, code_col: str = "commodity_code",
                         label_col: str = "commodity_label") -> DataFrame:
    """Add a readable label: HS2 chapter name, else ``'Commodity <code>'``.

    The chapter table has a fixed size (97 rows), so the lookup is a
    broadcast hash join; a NULL code keeps a NULL label.
    """
    cleaned, key = commodity_label_key(code_col)
    labels = broadcast_if_small(dims.hs2_labels(df.sparkSession).withColumnRenamed("label", "_hs2_label"))
    keyed = df.withColumns({"_code_clean": cleaned, "_hs2": key})
    return (keyed.join(labels, keyed["_hs2"] == labels["hs2"], "left")
            .withColumn(label_col, F.when(
                F.col(code_col).isNotNull(),
                F.coalesce(F.col("_hs2_label"), F.concat(F.lit("Commodity "), F.col("_code_clean")))))
            .drop("_code_clean", "_hs2", "hs2", "_hs2_label"))


# ---------------------------------------------------------------- growth ----

def monthly_growth(trend: DataFrame, by: list[str] | None = None,
                   value_col: str = "monthly_import_value") -> DataFrame:
    """Month date and percent change against the previous row in date order.

    The previous *row* is used (calendar gaps are not filled); the first row
    of a series and a zero base give NULL. ``by`` partitions the series
    (e.g. per country); without it the whole table is one series. A series is
    dealt by date over tasks, so no task holds a whole one; this writes the
    (aggregated) rows once.
    """
    dated = trend.withColumn("date", F.make_date("year", "month", F.lit(1)))
    rows = order.previous(dated, ["date"], value_col, "_previous", by)
    growth = pct_change(F.col(value_col).cast("double"), F.col("_previous").cast("double"))
    return rows.withColumn("growth_rate", growth).drop("_previous")


def select_years(df: DataFrame, years: list[int]) -> DataFrame:
    return df.filter(F.col("year").isin([int(y) for y in years]))


def select_countries(df: DataFrame, iso3: list[str]) -> DataFrame:
    return df.filter(F.col("country_iso3").isin(list(iso3)))


# ------------------------------------------------------------------ top-N ---

def top_n(df: DataFrame, measure: str, n: int, tie_break: list[str]) -> DataFrame:
    """Rows with the ``n`` largest non-null ``measure`` values, ties by key."""
    order = [F.col(measure).desc()] + [F.col(c).asc_nulls_last() for c in tie_break]
    return df.filter(F.col(measure).isNotNull()).orderBy(*order).limit(int(n))


def totals_by_label(labelled: DataFrame, measures: list[str],
                    label_col: str = "commodity_label") -> DataFrame:
    """Sum each measure per label (codes sharing a chapter are merged).

    The sums are exact, whatever the order of the rows.
    """
    return labelled.groupBy(label_col).agg(*[total(labelled, m).alias(m) for m in measures])


def share_of_total(df: DataFrame, measure: str, share_col: str = "share") -> DataFrame:
    """Each row's share of the table's total (used on a top-N set)."""
    whole = total(df, measure, over=Window.partitionBy())
    return df.withColumn(share_col, F.try_divide(F.col(measure).cast("double"), whole.cast("double")))


# -------------------------------------------------------------- histogram ---

def histogram(df: DataFrame, measure: str, bins: int) -> DataFrame:
    """Equal-width histogram over ``[min, max]`` of the non-null values.

    Returns every bin ``1..bins`` with ``lower``, ``upper`` and ``count``; the
    last bin is closed on the right; when ``min == max`` all values fall in
    bin 1; no values gives no rows. Two passes over the input: the bounds
    are one global aggregate used as a scalar subquery, and the counting is
    a partial + final aggregate on the bin number. The bin list itself is a
    ``bins``-row inline table, and only the per-bin counts (at most ``bins``
    rows, a proven bound) are broadcast to it.
    """
    values = df.select(F.col(measure).cast("double").alias("v")).filter(F.col("v").isNotNull())
    bounds = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("b")).scalar()
    # the scalar is projected once per side and read from that column
    lo, hi = F.col("b.lo"), F.col("b.hi")
    width = (hi - lo) / F.lit(float(bins))
    bin_of = F.when(hi == lo, F.lit(1)).otherwise(
        F.least(F.floor(F.try_divide(F.col("v") - lo, width)) + F.lit(1), F.lit(bins)))
    counts = (values.select("v", bounds.alias("b"))
              .groupBy(bin_of.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = (local_table(df.sparkSession, [(i,) for i in range(1, int(bins) + 1)], "bin int")
            .select("bin", bounds.alias("b")).filter(lo.isNotNull()))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    (lo + (F.col("bin") - 1) * width).alias("lower"),
                    F.when(F.col("bin") == bins, hi).otherwise(lo + F.col("bin") * width).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


# ------------------------------------------------------------------- KPIs ---

def kpi_trend(trend: DataFrame, value_col: str = "monthly_import_value") -> DataFrame:
    """Total, average and peak of a (filtered) monthly series, one row."""
    v = F.col(value_col)
    return trend.agg(total(trend, value_col).alias("total_import_value"),
                     mean(trend, value_col).alias("average_monthly_import"),
                     F.max(v).alias("peak_monthly_import"))


def _key_of_largest(key: str, measure: str) -> Column:
    """Key of the largest non-null measure; of equal ones the smallest key."""
    ranked = F.when(F.col(measure).isNotNull(), F.struct((-F.col(measure)).alias("m"), F.col(key).alias("k")))
    return F.min(ranked).getField("k")


def kpi_hosts(hosts: DataFrame) -> DataFrame:
    """Countries compared, the one with the highest imports, combined imports."""
    return hosts.agg(
        F.count_distinct("country_iso3").alias("countries_compared"),
        _key_of_largest("country_iso3", "total_import_value").alias("highest_import_country"),
        total(hosts, "total_import_value").alias("total_import_value"))


def kpi_predictions(predictions: DataFrame, by_label: DataFrame,
                    label_col: str = "commodity_label") -> DataFrame:
    """Total predicted demand (all codes), top label by score, max label score."""
    whole = predictions.agg(total(predictions, "predicted_demand")).scalar()
    return by_label.agg(
        _key_of_largest(label_col, "opportunity_score").alias("highest_opportunity"),
        F.max("opportunity_score").alias("max_opportunity_score"),
    ).select(whole.alias("total_predicted_demand"), "highest_opportunity",
             "max_opportunity_score")


# --------------------------------------------------------------- profiles ---

def row_profile(tables: dict[str, DataFrame], kept: dict[str, Column] | None = None) -> DataFrame:
    """One row per table: its row count and the count of rows passing ``kept``."""
    kept = kept or {}
    parts = [
        t.agg(F.count(F.lit(1)).alias("row_count"),
              F.count_if(kept.get(name, F.lit(True))).alias("kept_count"))
         .select(F.lit(name).alias("table_name"), "row_count", "kept_count")
        for name, t in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(df: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """``n`` rows drawn by the MD5 of ``keys`` (all columns by default): the same rows however the table is laid out."""
    keys = list(keys or df.columns)
    shown = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.withColumn("__drawn", F.md5(shown)).orderBy("__drawn", *keys).limit(int(n)).drop("__drawn")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def option_lists(options: dict[str, DataFrame]) -> DataFrame:
    """Sorted distinct selector options, long form ``(option_kind, option_value)``."""
    parts = [df.select(F.lit(kind).alias("option_kind"), F.col(df.columns[0]).cast("string")
                       .alias("option_value")).distinct()
             for kind, df in options.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("option_kind", "option_value")


# ----------------------------------------------------------- presentation ---

def with_position(df: DataFrame, keys: list[str | Column], by: list[str] | None = None,
                  name: str = "position") -> DataFrame:
    """Presentation order as a column, counted from 1 (in each ``by`` group), numbered over many tasks.

    The order must name enough columns to be unique.
    """
    return order.running(df, keys, by, name)
