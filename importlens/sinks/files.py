"""Writers.

Every write goes through Spark's commit protocol, so a lost executor only
re-runs its tasks and a failed job leaves the previous output in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _csv(df: DataFrame, mode: str):
    # a quote inside a quoted cell is doubled (RFC 4180)
    return df.write.mode(mode).option("header", True).option("escape", '"')


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV folder (one file per task)."""
    _csv(df, mode).csv(path)
    return path


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One header CSV file for a *result* table (bounded by construction).

    ``coalesce(1)`` funnels the rows through one task, so this is only for
    aggregated tables read back from their written copy.
    """
    _csv(df.coalesce(1), mode).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "overwrite", batch_size: int = 10000) -> None:
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    df.write.jdbc(url=url, table=table, mode=mode, properties=props)
