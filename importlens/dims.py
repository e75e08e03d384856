"""Dimension tables built from configuration.

Every dimension here has a fixed, configuration-sized row count, which is the
size bound that lets operators broadcast them. They are built as inline
``VALUES`` tables (a local relation), so the optimizer knows their exact
size and the size-checked broadcast can see it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from importlens import config, schemas
from importlens.sources.files import read_csv_typed


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A small table from Python rows as an inline ``VALUES`` relation."""
    fields = [f.strip().split(" ", 1) for f in ddl.split(",")]
    names = [f[0] for f in fields]
    if not rows:
        return spark.createDataFrame([], ddl)
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({', '.join(names)})")


def indicators(spark: SparkSession, mapping: dict[str, str] | None = None) -> DataFrame:
    rows = list((mapping or config.INDICATORS).items())
    return local_table(spark, rows, "indicator_code string, indicator_name string")


def host_counties(spark: SparkSession, rows: list[tuple[str, str, str]] | None = None) -> DataFrame:
    return local_table(spark, list(rows or config.HOST_COUNTIES),
                       "city string, state_abbr string, state_county_fips string")


def naics_sectors(spark: SparkSession, mapping: dict[str, str] | None = None) -> DataFrame:
    rows = list((mapping or config.NAICS_SECTORS).items())
    return local_table(spark, rows, "naics_prefix string, industry_group string")


def hs2_labels(spark: SparkSession) -> DataFrame:
    return local_table(spark, list(config.HS2_LABELS.items()), "hs2 string, label string")


def event_calendar(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The event calendar: read from a header CSV when ``path`` is given, else the configured one."""
    if path is not None:
        return read_csv_typed(spark, path, schemas.EVENT_CALENDAR)

    def d(s: str) -> _dt.date:
        return _dt.date.fromisoformat(s)

    rows = [(n, h, d(a), d(b), d(c), d(e), t) for n, h, a, b, c, e, t in config.EVENT_CALENDAR]
    return spark.createDataFrame(rows, schemas.EVENT_CALENDAR)
