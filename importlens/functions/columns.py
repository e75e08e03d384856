"""Scalar column expressions shared by the operators.

All of them are native Spark expressions (no Python UDF), null-safe, and
ANSI-safe: malformed input becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from importlens.functions.exact import total

# A plain decimal number with optional sign, fraction and exponent and
# surrounding blanks -- the strings a coercing numeric parser accepts.
_NUMERIC_TEXT = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_number(c: str | Column, dtype: str = "double") -> Column:
    """Spark's own lenient cast: anything unparsable becomes NULL, NaN too."""
    v = _col(c).try_cast(dtype)
    if dtype in ("double", "float"):
        v = F.when(~F.isnan(v), v)
    return v


def strict_number(c: str | Column, dtype: str = "double") -> Column:
    """Coerce text to a number, NULL unless the text is a plain decimal number.

    Stricter than ``try_cast`` (which takes ``'12d'`` or ``'Infinity'``); this
    is the coercion used for county statistics where suppressed cells carry
    letters such as ``'D'``.
    """
    s = _col(c).cast("string")
    return F.when(s.rlike(_NUMERIC_TEXT), F.trim(s).try_cast(dtype))


def month_start_from_period(period: str | Column) -> Column:
    """``YYYYMM`` text -> first day of that month, NULL when not a valid month.

    Six plain digits are read as a number, any other text through the text of its date.
    """
    p = _col(period).cast("string")
    n = p.try_cast("int")
    year, month = F.floor(n / 100).cast("int"), n % 100
    text = F.concat(F.substring(p, 1, 4), F.lit("-"), F.substring(p, 5, 2), F.lit("-01"))
    return (F.when(n.between(100000, 999999) & (n.cast("string") == p),
                   F.when(month.between(1, 12), F.make_date(year, month, F.lit(1))))
            .otherwise(text.try_cast("date")))


def zfill(c: str | Column, width: int) -> Column:
    """Left-pad with zeros up to ``width``; longer text is kept whole.

    A leading sign stays in front of the padding (``'-1'`` -> ``'-01'``).
    """
    s = _col(c).cast("string")
    head = F.substring(s, 1, 1)
    signed = F.concat(head, F.lpad(F.substring(s, 2, width), width - 1, "0"))
    return (F.when(F.length(s) >= width, s)
            .when(head.isin("+", "-"), signed)
            .otherwise(F.lpad(s, width, "0")))


def strip_ws(c: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind (not only blanks)."""
    return F.regexp_replace(_col(c), r"^(?U)\s+|(?U)\s+$", "")


def commodity_label_key(code: str | Column) -> tuple[Column, Column]:
    """Return ``(cleaned_code, hs2_key)`` for a commodity code.

    The cleaned code drops every literal ``'.0'`` and surrounding whitespace;
    the key is its first two characters, zero-padded to two.
    """
    cleaned = strip_ws(F.replace(_col(code).cast("string"), F.lit(".0"), F.lit("")))
    return cleaned, F.lpad(F.substring(cleaned, 1, 2), 2, "0")


def mean(df: DataFrame, c: str) -> Column:
    """Average of column ``c`` of ``df`` as ``double(sum) / count``; the sum is exact, whatever the order of the rows."""
    return F.try_divide(total(df, c).cast("double"), F.count(F.col(c)))


def pct_change(value: str | Column, previous: str | Column) -> Column:
    """Percent change from ``previous`` to ``value``; NULL without a usable base."""
    v, p = _col(value), _col(previous)
    return F.try_multiply(F.try_divide(v - p, p), F.lit(100.0))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double (the published measure type)."""
    if not any(isinstance(f.dataType, DecimalType) for f in df.schema.fields):
        return df
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
    ])
