"""Sums of doubles that do not depend on the order of the rows.

A double is cut into whole-number bands: below ``2^-52``, below 1, below ``2^56``,
below ``2^112`` and below ``2^168``. Remainders and powers of two are exact on
doubles, a band is added as two whole numbers of half its bits (exact up to ``2^35``
rows of a group), and the five band sums are put together in one fixed order at the end. Any partitioning, retry or order of rows therefore gives
the same double. Bits below ``2^-104`` are left out; magnitudes from ``2^168`` on,
infinities and NaN are added as plain doubles beside the bands, so no row is lost.

Everything is one aggregate column of native expressions (partial sums before the
shuffle, usable in ``agg``, ``pivot`` and over windows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType
from pyspark.sql.window import WindowSpec

_FRACTION, _WHOLE = 52, 56          # bits of a band below and above the point
_HALF = 28                          # a band is added as its low 28 bits and the rest
_TOP = 3 * _WHOLE                   # magnitudes from 2^_TOP on are added plainly


def _two(power: int) -> float:
    return 2.0 ** power


def exact_sum(c: str | Column, over: WindowSpec | None = None) -> Column:
    """Order-free sum of a double column; null if no value is there."""
    v = (F.col(c) if isinstance(c, str) else c).cast("double")
    inside = F.abs(v) < F.lit(_two(_TOP))
    x = F.when(inside, v)
    fraction = (x % F.lit(1.0)) * F.lit(_two(_FRACTION))
    bands = [                                                    # (whole number, power of two of its unit)
        ((x % F.lit(_two(_TOP))) / F.lit(_two(2 * _WHOLE)), 2 * _WHOLE),
        ((x % F.lit(_two(2 * _WHOLE))) / F.lit(_two(_WHOLE)), _WHOLE),
        (x % F.lit(_two(_WHOLE)), 0),
        (fraction, -_FRACTION),
        ((fraction % F.lit(1.0)) * F.lit(_two(_FRACTION)), -2 * _FRACTION),
    ]

    def total(value: Column) -> Column:
        s = F.sum(value)
        return s.over(over) if over is not None else s

    def band_total(value: Column) -> Column:
        whole = value.cast("bigint")
        low, high = total(whole.bitwiseAND(F.lit((1 << _HALF) - 1))), total(F.shiftright(whole, _HALF))
        both = high.cast("decimal(20,0)") * F.lit(1 << _HALF).cast("decimal(10,0)") + low.cast("decimal(20,0)")
        return F.coalesce(both.cast("double"), F.lit(0.0))

    parts = [band_total(b) * F.lit(_two(p)) for b, p in bands]
    out = parts[-1]
    for p in reversed(parts[:-1]):                               # the smallest bands first
        out = p + out
    plain = total(F.when(~inside, v))
    some = F.count(v).over(over) if over is not None else F.count(v)
    return F.when(some > 0, F.when(plain.isNull(), out).otherwise(plain + out))


def total(df: DataFrame, c: str, value: Column | None = None, over: WindowSpec | None = None) -> Column:
    """Sum of column ``c`` of ``df`` (or of ``value`` made of it): exact for its type, whatever the order of the rows."""
    v = value if value is not None else F.col(c)
    if isinstance(df.schema[c].dataType, DecimalType):
        return F.sum(v).over(over) if over is not None else F.sum(v)
    return exact_sum(v, over)


def sql_exact_sum(value: str, where: str | None = None, over: str | None = None) -> str:
    """The same sum as SQL text for the independent engine (``over``: window text such as ``OVER ()``)."""
    tail = (f" FILTER (WHERE {where})" if where else "") + (f" {over}" if over else "")
    v = f"CAST({value} AS DOUBLE)"
    x = f"CASE WHEN abs({v}) < {_two(_TOP)!r}::DOUBLE THEN {v} END"
    two = lambda p: f"{_two(p)!r}::DOUBLE"
    fraction = f"((({x}) % 1.0::DOUBLE) * {two(_FRACTION)})"
    bands = [
        (f"((({x}) % {two(_TOP)}) / {two(2 * _WHOLE)})", 2 * _WHOLE),
        (f"((({x}) % {two(2 * _WHOLE)}) / {two(_WHOLE)})", _WHOLE),
        (f"(({x}) % {two(_WHOLE)})", 0),
        (fraction, -_FRACTION),
        (f"(({fraction} % 1.0::DOUBLE) * {two(_FRACTION)})", -2 * _FRACTION),
    ]
    # through text: a whole number becomes its nearest double
    parts = [f"COALESCE(CAST(CAST(SUM(CAST(trunc({b}) AS BIGINT)){tail} AS VARCHAR) AS DOUBLE), 0.0::DOUBLE) * {two(p)}" for b, p in bands]
    out = parts[-1]
    for p in reversed(parts[:-1]):
        out = f"({p} + {out})"
    plain = f"SUM(CASE WHEN NOT abs({v}) < {two(_TOP)} THEN {v} END){tail}"
    return f"(CASE WHEN COUNT({value}){tail} > 0 THEN CASE WHEN {plain} IS NULL THEN {out} ELSE {plain} + {out} END END)"
