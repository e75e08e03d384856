"""Landing copies of the fixture views as files, for the source/sink queries.

Files are written once per session and scale-factor folder, under the
session's shared checkpoint folder (never a machine-local path unless the
session has none configured, as in tests).
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession

from importlens.plans import fixtures, inputs
from importlens.plans.stages import input_mark
from importlens.session import app_id, work_dir
from importlens.sinks.files import write_csv

_LOCK = threading.Lock()
_STAGED: dict[tuple[str, tuple, str], str] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple[str, tuple, str]:
    return (app_id(spark), input_mark(spark, sf_dir), what)


def trade_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw trade export as one CSV folder (text columns, header)."""
    key = _key(spark, sf_dir, "trade_csv")
    with _LOCK:
        if key not in _STAGED:
            path = work_dir(spark, "landed-trade")
            write_csv(inputs.trade_raw(spark, sf_dir).drop("region_key"), path)
            _STAGED[key] = path
        return _STAGED[key]


def trade_csv_by_country(spark: SparkSession, sf_dir: str) -> str:
    """The raw trade export as one folder per country (``country_iso3=<iso3>``)."""
    key = _key(spark, sf_dir, "trade_csv_by_country")
    with _LOCK:
        if key not in _STAGED:
            path = work_dir(spark, "landed-trade-by-country")
            (inputs.trade_raw(spark, sf_dir).drop("region_key")
             .hint("rebalance", "country_iso3").write.mode("overwrite").option("header", True).option("escape", '"')
             .partitionBy("country_iso3").csv(path))
            _STAGED[key] = path
        return _STAGED[key]


def county_csv(spark: SparkSession, sf_dir: str) -> str:
    """The county business file as it lands: CSV text under its messy header."""
    key = _key(spark, sf_dir, "county_csv")
    with _LOCK:
        if key not in _STAGED:
            path = work_dir(spark, "landed-county")
            write_csv(fixtures.county_raw(spark, sf_dir), path)
            _STAGED[key] = path
        return _STAGED[key]
