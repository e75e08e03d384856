"""Schema harmonisation decided at plan time from a frame's columns.

Landed files differ in their headers (value column alias, period column,
missing description). The choices below look at ``df.columns`` once, when the
plan is built, and emit a single projection -- nothing is evaluated per row.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from importlens import config


def first_present(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate that is a column, compared case-sensitively."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def resolve_roles(columns: Iterable[str], roles: dict[str, list[str]]) -> dict[str, str]:
    """Map each role to its first present candidate; raise naming every missing role."""
    cols = list(columns)
    found = {role: first_present(cols, cands) for role, cands in roles.items()}
    missing = [role for role, c in found.items() if c is None]
    if missing:
        raise ValueError(f"no column found for {missing}; the header has {', '.join(cols)}")
    return found  # type: ignore[return-value]


def normalize_headers(df: DataFrame) -> DataFrame:
    """Upper-case and strip every column name."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def trade_renames(columns: Iterable[str]) -> dict[str, str]:
    """What the columns of one landed header are called in the common column set.

    * ``cmdCode``/``cmdDesc`` -> ``commodity_code``/``commodity_desc`` when present;
    * only the first present of the value aliases becomes ``trade_value``;
    * ``extract_period`` becomes ``period`` only when ``period`` is absent.
    """
    cols = list(columns)
    renames = {src: dst for src, dst in config.TRADE_RENAMES.items() if src in cols}
    value_col = first_present(cols, config.TRADE_VALUE_ALIASES)
    if value_col is not None:
        renames[value_col] = "trade_value"
    if "period" not in cols and "extract_period" in cols:
        renames["extract_period"] = "period"
    return renames


def harmonize_trade(df: DataFrame, iso3: str | None = None) -> DataFrame:
    """Rename a landed trade frame to the common column set (see ``trade_renames``).

    ``country_iso3`` is added from ``iso3`` when missing; a missing description
    becomes a typed NULL column.
    """
    renames = trade_renames(df.columns)
    out = df.withColumnsRenamed(renames) if renames else df
    added = {}
    if "country_iso3" not in out.columns:
        added["country_iso3"] = F.lit(iso3).cast("string")
    if "commodity_desc" not in out.columns:
        added["commodity_desc"] = F.lit(None).cast("string")
    return out.withColumns(added) if added else out


TRADE_COLUMNS = ["country_iso3", "commodity_code", "commodity_desc", "trade_value", "period"]


def harmonize_layouts(df: DataFrame, layout: str, headers: Mapping[object, Iterable[str]]) -> DataFrame:
    """Harmonise rows of several headers in one pass over one frame.

    ``df`` holds the columns of all headers, and its column ``layout`` says which
    header a row came under; ``headers`` has the columns of each. Every header makes
    its own choices, as ``harmonize_trade`` does for a frame; each common column
    is one expression over ``layout``. Rows of an unknown layout have NULLs.
    """
    picked = {}
    for target in TRADE_COLUMNS:
        chosen = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, columns in headers.items():
            own = {dst: src for src, dst in trade_renames(columns).items()}
            source = own.get(target, target if target in set(columns) else None)
            if source is not None:
                chosen = chosen.when(F.col(layout) == F.lit(name), F.col(source))
        picked[target] = chosen.alias(target)
    return df.select(F.col(layout), *picked.values())


def concat_layouts(df: DataFrame, layout: str, frames: Mapping[object, Mapping[str, Column]]) -> DataFrame:
    """Row concatenation of frames cut from one table, in one scan of it.

    ``frames`` gives, for every value of ``layout``, the frame's columns; the result has
    the columns of all, NULL where a frame lacks one, and ``layout``.
    """
    names = list(dict.fromkeys(c for columns in frames.values() for c in columns))
    out = []
    for c in names:
        value = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, columns in frames.items():
            if c in columns:
                value = value.when(F.col(layout) == F.lit(name), columns[c])
        out.append(value.alias(c))
    return df.where(F.col(layout).isin(list(frames))).select(F.col(layout), *out)


def union_all_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from a frame become NULL."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_frame(df: DataFrame, **constants: str) -> DataFrame:
    """Add constant text columns (e.g. the country and period of a landed pull)."""
    return df.withColumns({k: F.lit(v).cast("string") for k, v in constants.items()})
