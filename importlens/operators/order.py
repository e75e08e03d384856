"""Total order as data: positions, running totals and the previous row, without one task holding a series.

A window without ``PARTITION BY`` puts a whole series into one task, and one
with it puts a whole key there. Here the rows are dealt by range over the
session's shuffle partitions, sorted inside them and written; ``_part`` and
``_row`` name the place of each row. What earlier partitions hold of the same
series is summed from one row a partition and series, and added. At most one
series continues across each partition boundary, so the rows that are carried
over number no more than the partitions and are broadcast.

The input is read twice (bounds, then rows), so it should be a written table if
it is costly. Rows that are equal in ``by`` and ``order`` get neighbouring
positions in no fixed order. Nulls order as the columns say (ascending: first).
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from importlens.session import work_dir

_ROW_BITS = 33      # a partition's rows are numbered below 2^33 by Spark


def ordered_parts(df: DataFrame, order: list[str | Column], by: list[str] | None = None) -> DataFrame:
    """``df`` dealt by range of ``(by, order)`` and sorted, written, with ``_part`` and ``_row`` (from 0)."""
    keys = [F.col(c) for c in by or []] + [F.col(c) if isinstance(c, str) else c for c in order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = work_dir(df.sparkSession, "ordered")
    dealt.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    return rows.select(*df.columns, F.shiftright("_id", _ROW_BITS).alias("_part"),
                       F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"))


def _carried(rows: DataFrame, by: list[str], own: dict[str, Column], before: dict[str, Column]) -> DataFrame:
    """``rows`` beside what earlier partitions hold of the row's series (one row a boundary, broadcast)."""
    runs = rows.groupBy("_part", *by).agg(*[c.alias(n) for n, c in own.items()])
    earlier = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_part")
    carry = runs.select("_part", *by, *[c(earlier).alias(f"_before_{n}") for n, c in before.items()])
    carry = carry.where(F.coalesce(*[F.col(f"_before_{n}").isNotNull() for n in before]))
    keys = {c: f"_key_{i}" for i, c in enumerate(["_part", *by])}
    carry = carry.withColumnsRenamed(keys)
    same = [rows[c].eqNullSafe(carry[k]) for c, k in keys.items()]
    joined = rows.join(F.broadcast(carry), same, "left")
    return joined.drop(*keys.values())


def running(df: DataFrame, order: list[str | Column], by: list[str] | None = None, position: str = "position",
            totals: Mapping[str, str | Column] | None = None) -> DataFrame:
    """``df`` with ``position`` (from 1, in each ``by`` group) and running totals up to and with the row.

    ``totals`` maps a new column to the whole-number column it adds up (null counts as 0).
    """
    by, totals = list(by or []), {n: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).cast("long")
                                  for n, c in (totals or {}).items()}
    rows = ordered_parts(df, order, by)
    if by or totals:
        here = Window.partitionBy("_part", *by).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        local = {position: F.count(F.lit(1)).over(here)} | {n: F.sum(c).over(here) for n, c in totals.items()}
    else:
        local = {position: F.col("_row") + 1}
    own = {position: F.count(F.lit(1))} | {n: F.sum(c) for n, c in totals.items()}
    before = {n: (lambda w, n=n: F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1))) for n in own}
    out = _carried(rows, by, own, before)
    return out.select(*df.columns, *[(c + F.coalesce(F.col(f"_before_{n}"), F.lit(0))).cast("long").alias(n)
                                     for n, c in local.items()])


def previous(df: DataFrame, order: list[str | Column], value: str, name: str, by: list[str] | None = None) -> DataFrame:
    """``df`` with ``name``, the ``value`` of the row before in each ``by`` series (null in its first row)."""
    by = list(by or [])
    rows = ordered_parts(df, order, by)
    here = Window.partitionBy("_part", *by).orderBy("_row")
    # wrapped, so that a null value and no row before are told apart
    held = F.struct(F.col(value).alias("v"))
    out = _carried(rows, by, {"held": F.max_by(held, "_row")}, {"held": lambda w: F.lag("held").over(w)})
    before = F.when(F.row_number().over(here) > 1, F.lag(F.col(value)).over(here)).otherwise(F.col("_before_held.v"))
    return out.select(*df.columns, before.alias(name))
