"""Landed indicator payloads -> indicator rows.

A landed payload is the JSON text of one response, ``[meta, [item, ...]]``,
stored next to the request keys (``country_iso3``, ``indicator_code``).
Payloads with fewer than two elements or a NULL second element yield no
rows. Parsing is native (``get_json_object`` + ``from_json``) and runs per
row on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from importlens.operators.joins import broadcast_if_small
from importlens.schemas import INDICATOR_ITEMS_DDL


def flatten_indicator_payloads(landed: DataFrame, indicator_dim: DataFrame,
                               years: list[int], payload_col: str = "payload") -> DataFrame:
    """One row per item: country, country name, year, indicator code and name, value.

    Items whose year is not in ``years`` (or not an integer) are dropped; the
    friendly name comes from the configuration-sized indicator dimension.
    """
    items = F.from_json(F.get_json_object(F.col(payload_col), "$[1]"), INDICATOR_ITEMS_DDL)
    rows = (landed.select("country_iso3", "indicator_code", F.explode(items).alias("it"))
            .select("country_iso3",
                    F.col("it.country.value").alias("country_name"),
                    F.col("it.date").try_cast("int").alias("year"),
                    "indicator_code",
                    F.col("it.value").alias("value"))
            .filter(F.col("year").isin([int(y) for y in years])))
    names = broadcast_if_small(indicator_dim.select("indicator_code", "indicator_name"))
    return (rows.join(names, "indicator_code", "left")
            .select("country_iso3", "country_name", "year", "indicator_code",
                    "indicator_name", "value"))
