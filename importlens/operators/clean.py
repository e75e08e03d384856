"""Cleaning of the three landed inputs into typed tables.

``measure_type`` is the type measures are parsed into: ``double`` as
published, or an exact ``decimal(p,s)`` when sums must not depend on the
order rows are added in.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from importlens import config
from importlens.functions.columns import (
    lenient_number, month_start_from_period, strict_number, zfill,
)
from importlens.operators.joins import broadcast_if_small
from importlens.operators.harmonize import (
    harmonize_trade, normalize_headers, resolve_roles, union_all_by_name,
)


def clean_trade_frame(df: DataFrame, iso3: str | None = None,
                      measure_type: str = "double") -> DataFrame:
    """Harmonise one landed trade frame and type its columns (no row is dropped here)."""
    h = harmonize_trade(df, iso3)
    missing = [c for c in ("commodity_code", "trade_value", "period") if c not in h.columns]
    if missing:
        raise ValueError(f"a trade export needs {', '.join(missing)}; its header has {', '.join(df.columns)}")
    return typed_trade(h, measure_type)


def typed_trade(harmonised: DataFrame, measure_type: str = "double") -> DataFrame:
    """The common columns with their types."""
    return harmonised.select(
        F.col("country_iso3").cast("string").alias("country_iso3"),
        F.col("commodity_code").cast("string").alias("commodity_code"),
        F.col("commodity_desc").cast("string").alias("commodity_desc"),
        lenient_number("trade_value", measure_type).alias("trade_value"),
        month_start_from_period("period").alias("month_date"),
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows without a usable value or month."""
    return df.dropna(subset=["trade_value", "month_date"])


def clean_trade(frames: DataFrame | Mapping[str, DataFrame],
                measure_type: str = "double") -> DataFrame:
    """Clean landed trade: one frame, or ``{iso3: frame}`` tagged per country.

    Frames are harmonised one by one (each keeps its own header choices),
    unioned by name, and rows missing a value or a month are dropped.
    """
    if isinstance(frames, DataFrame):
        parts = [clean_trade_frame(frames, None, measure_type)]
    else:
        parts = [clean_trade_frame(df, iso3, measure_type) for iso3, df in frames.items()]
    return drop_incomplete(union_all_by_name(parts))


def clean_indicators(df: DataFrame, measure_type: str = "double") -> DataFrame:
    """Type the landed indicator rows: integer year, numeric value."""
    return df.withColumns({
        "year": F.col("year").try_cast("int"),
        "value": lenient_number("value", measure_type),
    })


def extract_county(df: DataFrame, host_counties: DataFrame, sectors: DataFrame,
                   measure_type: str = "double") -> DataFrame:
    """County business rows of the host counties and in-scope sectors.

    Headers are normalised and resolved by role (error names every missing
    role); the 5-digit FIPS is built from zero-padded state and county; both
    dimension filters are inner joins against configuration-sized tables,
    broadcast after a size check.
    """
    src = normalize_headers(df)
    roles = resolve_roles(src.columns, config.COUNTY_ROLES)
    picked = src.select(*[
        F.col(roles[role]).cast("string").alias(config.COUNTY_ROLE_NAMES[role])
        for role in config.COUNTY_ROLES
    ])
    keyed = picked.withColumns({
        "state_county_fips": F.concat(zfill("STATE", 2), zfill("COUNTY", 3)),
        "naics_prefix": F.substring("naics_code", 1, 2),
    })
    counties = host_counties.select("state_county_fips", "city", "state_abbr")
    groups = sectors.select("naics_prefix", "industry_group")
    joined = (keyed
              .join(broadcast_if_small(counties), "state_county_fips", "inner")
              .join(broadcast_if_small(groups), "naics_prefix", "inner"))
    return joined.select(
        "city", "state_abbr", "state_county_fips", "naics_code", "naics_prefix", "industry_group",
        strict_number("ESTAB", measure_type).alias("ESTAB"),
        strict_number("EMP", measure_type).alias("EMP"),
        strict_number("PAYANN", measure_type).alias("PAYANN"),
    )


def clean_county(df: DataFrame, measure_type: str = "double") -> DataFrame:
    """Readable measure names on the filtered county rows, typed numeric."""
    return df.withColumnsRenamed({
        "ESTAB": "establishments", "EMP": "employment", "PAYANN": "annual_payroll",
    }).withColumns({
        c: lenient_number(c, measure_type)
        for c in ("establishments", "employment", "annual_payroll")
    })
