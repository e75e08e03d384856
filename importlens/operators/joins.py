"""Size-checked broadcast for dimension joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer's size estimate of ``df`` (no job is run)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes; negative when broadcasts are switched off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)) \
        if not text.startswith("-") else -1


def broadcast_if_small(df: DataFrame, limit_bytes: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast only when its estimated size is under the limit.

    The limit defaults to the session's broadcast threshold (with its unit; a
    negative one switches the hint off). Above it the join stays a shuffle
    join, which adaptive execution may still turn into a broadcast from
    measured sizes.
    """
    limit = broadcast_limit(df) if limit_bytes is None else limit_bytes
    return F.broadcast(df) if 0 <= estimated_bytes(df) <= limit else df


def hashed_if_large(df: DataFrame) -> DataFrame:
    """Mark ``df``, a side with few rows a key, for broadcast if it is small, else as the hashed side of a shuffle join.

    The other side is then streamed by partition and never sorted, which is its cost when it is a fact table.
    """
    small = 0 <= estimated_bytes(df) <= broadcast_limit(df)
    return F.broadcast(df) if small else df.hint("shuffle_hash")
