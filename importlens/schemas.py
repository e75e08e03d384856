"""Declared schemas: no stage infers types from data."""

from __future__ import annotations

from pyspark.sql.types import DateType, StringType, StructField, StructType


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Landed JSON responses, one per line with its request keys.
INDICATOR_PAYLOADS = strings("country_iso3", "indicator_code", "payload")

EVENT_CALENDAR = StructType([
    StructField("event_name", StringType(), True),
    StructField("host_iso3", StringType(), True),
    StructField("event_start", DateType(), True),
    StructField("window_6m", DateType(), True),
    StructField("window_12m", DateType(), True),
    StructField("window_18m", DateType(), True),
    StructField("event_type", StringType(), True),
])

# Items of a landed indicator payload ``[meta, [item, ...]]``.
INDICATOR_ITEMS_DDL = "array<struct<country:struct<value:string>,date:string,value:double>>"
