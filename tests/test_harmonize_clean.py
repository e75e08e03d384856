"""Harmonisation and cleaning on hand-made landed files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from importlens import dims
from importlens.operators import measures
from importlens.operators.clean import (
    clean_county, clean_indicators, clean_trade, clean_trade_frame, extract_county,
)
from importlens.operators.harmonize import (
    first_present, harmonize_trade, resolve_roles, union_all_by_name,
)
from importlens.sources.files import read_csv_strings
from tests.conftest import write_text


def test_first_present_is_case_sensitive_and_ordered():
    assert first_present(["cifvalue", "primaryValue"], ["primaryValue", "cifvalue"]) == "primaryValue"
    assert first_present(["PRIMARYVALUE"], ["primaryValue"]) is None


def test_primary_value_wins_and_rollup_excluded(spark, tmp_dir):
    p = write_text(tmp_dir, "qat.csv",
                   "cmdCode,cmdDesc,primaryValue,cifvalue,period\n"
                   "01,Live animals,100.5,90,202201\n"
                   "TOTAL,All,999,1,202201\n")
    raw = read_csv_strings(spark, p)
    clean = clean_trade({"QAT": raw})
    rows = {r.commodity_code: r for r in clean.collect()}
    assert rows["01"].trade_value == 100.5
    assert rows["01"].month_date == dt.date(2022, 1, 1)
    assert rows["01"].country_iso3 == "QAT"
    kept = measures.exclude_rollup(clean).collect()
    assert [r.commodity_code for r in kept] == ["01"]


def test_fob_alias_period_fallback_and_bad_rows(spark, tmp_dir):
    p = write_text(tmp_dir, "usa.csv",
                   "cmdCode,fobvalue,extract_period\n"
                   "0101,7,202213\n"
                   "02,x,202202\n"
                   "03,5,2022\n"
                   "04,6,202203\n")
    frame = clean_trade_frame(read_csv_strings(spark, p), "USA")
    got = {r.commodity_code: r for r in frame.collect()}
    assert got["0101"].trade_value == 7.0 and got["0101"].month_date is None      # month 13
    assert got["02"].trade_value is None                                            # bad number
    assert got["03"].month_date is None                                             # annual period
    assert got["04"].commodity_desc is None and got["04"].month_date == dt.date(2022, 3, 1)
    kept = clean_trade({"USA": read_csv_strings(spark, p)}).collect()
    assert [r.commodity_code for r in kept] == ["04"]


def test_five_char_period_is_lenient(spark):
    df = spark.createDataFrame([("01", "5", "20221")], "cmdCode string, primaryValue string, period string")
    assert clean_trade({"QAT": df}).collect()[0].month_date == dt.date(2022, 1, 1)


def test_null_code_dropped_by_rollup_filter(spark):
    df = spark.createDataFrame([(None, "1", "202203"), ("05", "2", "202203")],
                               "cmdCode string, primaryValue string, period string")
    kept = measures.exclude_rollup(clean_trade({"QAT": df})).collect()
    assert [r.commodity_code for r in kept] == ["05"]


def test_nan_value_dropped(spark):
    df = spark.createDataFrame([("01", "NaN", "202201"), ("02", "3", "202201")],
                               "cmdCode string, primaryValue string, period string")
    assert [r.commodity_code for r in clean_trade({"QAT": df}).collect()] == ["02"]


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", "x")], "a string, b string")
    b = spark.createDataFrame([("2", "y")], "a string, c string")
    rows = sorted(union_all_by_name([a, b]).collect(), key=lambda r: r.a)
    assert rows[0].c is None and rows[1].b is None


def test_harmonize_keeps_existing_period(spark):
    df = spark.createDataFrame([("01", "1", "202201", "199901")],
                               "cmdCode string, TradeValue string, period string, extract_period string")
    h = harmonize_trade(df, "MEX")
    assert "trade_value" in h.columns and "extract_period" in h.columns
    assert h.collect()[0].period == "202201"


def test_missing_value_column_raises(spark):
    df = spark.createDataFrame([("01", "202201")], "cmdCode string, period string")
    with pytest.raises(ValueError, match="trade_value"):
        clean_trade_frame(df, "QAT")


def test_county_extract_headers_zfill_coercion_filters(spark, tmp_dir):
    p = write_text(tmp_dir, "cbp.txt",
                   " fipstate ,fipscty,naics,est,emp,ap\n"
                   "6,37,23----,10,100,1000\n"
                   "06,037,44----,D,5,1\n"
                   "36,61,31----,1,1,1\n"
                   "1,1,23----,1,1,1\n")
    raw = read_csv_strings(spark, p)
    out = extract_county(raw, dims.host_counties(spark), dims.naics_sectors(spark))
    rows = sorted(out.collect(), key=lambda r: r.naics_code)
    assert [r.naics_code for r in rows] == ["23----", "44----"]
    assert all(r.state_county_fips == "06037" and r.city == "Los Angeles" for r in rows)
    assert rows[0].industry_group == "Construction" and rows[1].industry_group == "Retail Trade"
    assert rows[1].ESTAB is None and rows[1].EMP == 5.0
    cleaned = clean_county(out)
    assert {"establishments", "employment", "annual_payroll"} <= set(cleaned.columns)


def test_county_missing_role_names_it(spark):
    df = spark.createDataFrame([("1", "2", "23", "1", "1")], "STATE string, COUNTY string, NAICS string, EST string, AP string")
    with pytest.raises(ValueError, match="emp"):
        extract_county(df, dims.host_counties(spark), dims.naics_sectors(spark))


def test_resolve_roles_lists_every_missing_role():
    with pytest.raises(ValueError) as err:
        resolve_roles(["STATE"], {"state": ["STATE"], "county": ["COUNTY"], "naics": ["NAICS"]})
    assert "'county'" in str(err.value) and "'naics'" in str(err.value)


def test_strict_number_rejects_letters_and_keeps_signs(spark):
    from importlens.functions.columns import strict_number
    df = spark.createDataFrame([("12d",), (" 12 ",), ("-3.5",), ("1e3",), ("D",), ("",)], "s string")
    got = [r.v for r in df.select(strict_number("s").alias("v")).collect()]
    assert got == [None, 12.0, -3.5, 1000.0, None, None]


def test_zfill_keeps_long_text(spark):
    from importlens.functions.columns import zfill
    df = spark.createDataFrame([("6",), ("1234",), (None,)], "s string")
    assert [r.v for r in df.select(zfill("s", 3).alias("v")).collect()] == ["006", "1234", None]


def test_clean_indicators_types(spark):
    df = spark.createDataFrame([("QAT", "Qatar", "2022", "c", "n", "1.5"), ("QAT", "Qatar", "x", "c", "n", None)],
                               "country_iso3 string, country_name string, year string, indicator_code string, "
                               "indicator_name string, value string")
    rows = clean_indicators(df).collect()
    assert rows[0].year == 2022 and rows[0].value == 1.5
    assert rows[1].year is None and rows[1].value is None


def test_dimension_joins_are_broadcast(spark):
    from importlens.operators.report import with_commodity_label
    raw = spark.createDataFrame([("6", "37", "23----", "1", "2", "3")],
                                "STATE string, COUNTY string, NAICS string, EST string, EMP string, AP string")
    plan = extract_county(raw, dims.host_counties(spark), dims.naics_sectors(spark)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    codes = spark.createDataFrame([("01",)], "commodity_code string")
    plan = with_commodity_label(codes)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
