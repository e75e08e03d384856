"""Measures, forecast and report operators on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from importlens.operators import forecast, measures, report

TRADE = "country_iso3 string, commodity_code string, commodity_desc string, trade_value double, month_date date"
IND = ("country_iso3 string, country_name string, year int, indicator_code string, "
       "indicator_name string, value double")


def trade(spark, rows):
    return spark.createDataFrame(rows, TRADE)


def test_imports_by_year_sum_and_distinct(spark):
    d = dt.date
    t = trade(spark, [("QAT", "01", "a", 1.0, d(2020, 1, 1)), ("QAT", "01", "a", 2.0, d(2020, 2, 1)),
                      ("QAT", "02", "b", 4.0, d(2020, 2, 1)), ("QAT", "TOTAL", "t", 9.0, d(2020, 2, 1)),
                      ("USA", "01", "a", 8.0, d(2021, 1, 1))])
    rows = {(r.country_iso3, r.year): r for r in measures.imports_by_year(t).collect()}
    assert rows[("QAT", 2020)].total_import_value == 7.0
    assert rows[("QAT", 2020)].distinct_commodities == 2
    assert rows[("USA", 2021)].distinct_commodities == 1


def test_host_comparison_left_join_keeps_indicator_only_countries(spark):
    d = dt.date
    t = trade(spark, [("QAT", "01", "a", 2.0, d(2020, 1, 1)), ("QAT", "02", "a", 4.0, d(2020, 1, 1))])
    ind = spark.createDataFrame([("QAT", "Qatar", 2020, "g", "gdp_per_capita", 10.0),
                                 ("QAT", "Qatar", 2021, "g", "gdp_per_capita", 20.0),
                                 ("USA", "US", 2020, "p", "population", 5.0),
                                 ("USA", "US", 2021, "p", "population", None)], IND)
    rows = {r.country_iso3: r for r in measures.host_comparison(t, ind).collect()}
    assert rows["QAT"].gdp_per_capita == 15.0 and rows["QAT"].total_import_value == 6.0
    assert rows["QAT"].average_transaction_value == 3.0
    assert rows["USA"].population == 5.0 and rows["USA"].total_import_value is None
    assert rows["USA"].inflation_percent is None      # absent indicator -> NULL column


def test_pivot_equals_long_average(spark):
    ind = spark.createDataFrame([("A", "a", y, "c", n, float(y * k)) for y in (1, 2, 3)
                                 for k, n in ((1, "x"), (2, "y"))], IND)
    wide = measures.indicator_pivot(ind, ["x", "y"]).collect()[0]
    longs = {r.indicator_name: r.average_indicator_value
             for r in measures.indicator_averages(ind).collect()}
    assert wide.x == longs["x"] and wide.y == longs["y"]


def _forecast_inputs(spark):
    d = dt.date
    t = trade(spark, [("QAT", "01", "a", 100.0, d(2022, 1, 1)), ("QAT", "02", "b", 50.0, d(2022, 1, 1)),
                      ("QAT", "TOTAL", "t", 999.0, d(2022, 1, 1))])
    ind = spark.createDataFrame([("QAT", "Q", 2022, "g", "gdp_per_capita", 50.0),
                                 ("USA", "U", 2022, "g", "gdp_per_capita", 100.0),
                                 ("MEX", "M", 2022, "g", "gdp_per_capita", 25.0)], IND)
    county = spark.createDataFrame([(9.0,), (None,)], "employment double")
    return t, ind, county


def test_forecast_factor_capacity_and_score(spark):
    t, ind, county = _forecast_inputs(spark)
    factors = {r.country_iso3: r.gdp_factor for r in forecast.scaling_factor(ind).collect()}
    assert factors == {"QAT": 0.5, "USA": 1.0, "MEX": 0.25}
    assert forecast.capacity(county).collect()[0].avg_employment == 9.0
    rows = {r.commodity_code: r for r in forecast.stocking_prediction(t, ind, county, "QAT", "MEX").collect()}
    assert set(rows) == {"01", "02"}
    assert rows["01"].predicted_demand == 25.0 and rows["01"].opportunity_score == 2.5


def test_forecast_absent_target_gives_null(spark):
    t, ind, county = _forecast_inputs(spark)
    rows = forecast.stocking_prediction(t, ind, county, "QAT", "CAN").collect()
    assert len(rows) == 2 and all(r.predicted_demand is None for r in rows)


def test_forecast_multi_target(spark):
    t, ind, county = _forecast_inputs(spark)
    rows = forecast.stocking_prediction_all(t, ind, county, "QAT", ["USA", "MEX", "CAN"]).collect()
    assert len(rows) == 6
    got = {(r.commodity_code, r.target_iso3): r.predicted_demand for r in rows}
    assert got[("02", "USA")] == 50.0 and got[("02", "CAN")] is None


def test_forecast_no_capacity_rows_null_score(spark):
    t, ind, _ = _forecast_inputs(spark)
    empty = spark.createDataFrame([], "employment double")
    rows = forecast.stocking_prediction(t, ind, empty, "QAT", "USA").collect()
    assert all(r.opportunity_score is None and r.predicted_demand is not None for r in rows)


def test_forecast_plan_has_no_cartesian_product(spark):
    t, ind, county = _forecast_inputs(spark)
    plan = forecast.stocking_prediction(t, ind, county, "QAT", "USA")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan


def test_labels(spark):
    codes = ["1", "01", "0101", "27.0", "10.05", "77", "TOTAL", " 84 ", None]
    df = spark.createDataFrame([(c,) for c in codes], "commodity_code string")
    got = {r.commodity_code: r.commodity_label for r in report.with_commodity_label(df).collect()}
    assert got["1"] == "Live Animals" and got["01"] == "Live Animals" and got["0101"] == "Live Animals"
    assert got["27.0"] == "Mineral Fuels"
    assert got["10.05"] == "Cereals"           # every '.0' removed: '105' -> '10'
    assert got["77"] == "Commodity 77"
    assert got["TOTAL"] == "Commodity TOTAL"
    assert got[" 84 "] == "Machinery"
    assert got[None] is None


def test_growth_previous_row_and_zero_base(spark):
    trend = spark.createDataFrame([(2022, 1, 100.0), (2022, 2, 150.0), (2022, 4, 0.0), (2022, 5, 50.0)],
                                  "year int, month int, monthly_import_value double")
    rows = [r.growth_rate for r in report.monthly_growth(trend).orderBy("date").collect()]
    assert rows == [None, 50.0, -100.0, None]


def test_growth_before_year_filter(spark):
    trend = spark.createDataFrame([(2021, 12, 100.0), (2022, 1, 110.0)],
                                  "year int, month int, monthly_import_value double")
    rows = report.select_years(report.monthly_growth(trend), [2022]).collect()
    assert len(rows) == 1 and abs(rows[0].growth_rate - 10.0) < 1e-9


def test_histogram_last_bin_closed_and_sums(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "opportunity_score double")
    h = sorted(report.histogram(df, "opportunity_score", 5).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in h] == [2, 2, 2, 2, 3]
    assert sum(r["count"] for r in h) == 11
    assert h[0].lower == 0.0 and h[-1].upper == 10.0


def test_histogram_degenerate_range(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    h = sorted(report.histogram(df, "v", 4).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in h] == [2, 0, 0, 0]


def test_histogram_empty_input(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert report.histogram(df, "v", 3).count() == 0


def test_top_n_tie_break_and_share(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0), ("d", None)], "k string, v double")
    top = report.top_n(df, "v", 2, ["k"]).collect()
    assert [r.k for r in top] == ["a", "b"]
    shares = report.share_of_total(report.top_n(df, "v", 3, ["k"]), "v").collect()
    assert abs(sum(r.share for r in shares) - 1.0) < 1e-12


def test_kpis(spark):
    hosts = spark.createDataFrame([("USA", 5.0), ("CAN", 7.0), ("MEX", None)],
                                  "country_iso3 string, total_import_value double")
    k = report.kpi_hosts(hosts).collect()[0]
    assert k.countries_compared == 3 and k.highest_import_country == "CAN" and k.total_import_value == 12.0
    empty = report.kpi_hosts(hosts.filter(F.lit(False))).collect()[0]
    assert empty.highest_import_country is None
    trend = spark.createDataFrame([(1.0,), (3.0,)], "monthly_import_value double")
    kt = report.kpi_trend(trend).collect()[0]
    assert (kt.total_import_value, kt.average_monthly_import, kt.peak_monthly_import) == (4.0, 2.0, 3.0)


def test_country_imports_equals_sum_of_years(spark):
    d = dt.date
    t = trade(spark, [("QAT", "01", "a", 1.0, d(2020, 1, 1)), ("QAT", "02", "a", 2.0, d(2021, 1, 1))])
    yearly = measures.imports_by_year(t)
    assert measures.country_imports(yearly).collect()[0].total_import_value == 3.0
