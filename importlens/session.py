"""Session construction and the shared working folder.

Library code never builds its own session; it receives one. ``build_session``
is for tests, the bench and the command line; it pins neither the master nor
the number of shuffle partitions unless asked to, so ``spark-submit`` settings
hold. ``work_dir`` returns a folder under ``spark.checkpoint.dir`` (the shared
folder the cluster names); an unset setting is an error, never a machine-local
path. Tests, the bench and local runs name their own folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "importlens", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        # Parquet sizes on disk are compressed; scale them towards in-memory
        # size so static broadcast decisions are not made on a fact table.
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        # long-running drivers: keep the status store (kept even without a UI) small
        .config("spark.ui.retainedJobs", "200")
        .config("spark.ui.retainedStages", "200")
        .config("spark.sql.ui.retainedExecutions", "50")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 -- sessions without a local context (remote clients)
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", "remote")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; raise if it is unset."""
    sc = _context(spark)
    current = spark.conf.get(_CHECKPOINT_KEY, None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        raise ValueError(
            f"{_CHECKPOINT_KEY} is not set: it must name a shared folder "
            "(stages, exports and stream checkpoints are written there)")
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
