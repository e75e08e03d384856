"""Helpers shared by the operators: tables, written cuts, Arrow passes, components."""

from __future__ import annotations

import gc
from contextlib import contextmanager
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.session import work_dir

#: Rows handed to Python at once. Documents can be long, so a batch is kept short.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    This cuts the lineage: a lost executor re-reads files, and a table that is
    used several times is computed once.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_uri(spark: SparkSession, path: str) -> str:
    """``path`` on its own file system, as a URI that Arrow opens in a task.

    A path without a scheme belongs to the session's default file system, which only
    Hadoop's configuration knows. Arrow opens ``file``, ``hdfs``, ``viewfs`` (through the
    Hadoop library), ``s3`` and ``gs``; Hadoop's names of the S3 scheme are translated.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    scheme, rest = uri.split(":", 1)
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    return f"{scheme}://{rest}" if not rest.startswith("//") else f"{scheme}:{rest}"


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are no longer held.

    Their cleaner runs when the driver's JVM collects garbage, which a mostly idle
    driver seldom does; between large stages the files would add up.
    """
    gc.collect()
    spark._jvm.System.gc()


#: A side of a join is broadcast up to so many rows of a few numbers (counted first).
BROADCAST_ROWS = 500_000


def counted_broadcast(side: DataFrame) -> DataFrame:
    """``side``, a written table of narrow rows, hinted for broadcast if it has few rows; else as it is."""
    return F.broadcast(side) if side.count() <= BROADCAST_ROWS else side


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands ``rows`` narrow rows to Python at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def arrow_pass(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``step`` to every Arrow batch of ``df``; rows stay in their partitions."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def same_key(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """Join on ``key`` with null equal to null; the result has ``left``'s key."""
    other = right.withColumnRenamed(key, f"__{key}")
    return left.join(other, left[key].eqNullSafe(other[f"__{key}"]), how).drop(f"__{key}")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected groups of the graph with edges ``(a, b)``: rows ``(node, root)``.

    Every node that occurs in a link gets the same ``root`` as the nodes it can
    reach; ``root`` is one of them. Each round points every node to the
    neighbour of lowest random priority and contracts the graph, so the number
    of rounds grows with the logarithm of the nodes whatever the links' shape.
    Only aggregations (combined before the shuffle) and equi-joins are used; a
    round is a written table. Links to itself or with a null end are ignored.
    """
    edges = (links.select("a", "b").where("a <> b")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = written(edges, f"{name}-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = written(nodes.select("node", F.col("node").alias("root")), f"{name}-labels")
    priority = lambda c: F.struct(F.xxhash64(c).alias("p"), F.col(c).alias("id"))
    while not edges.isEmpty():
        ends = edges.union(edges.select("b", "a"))
        best = ends.groupBy("a").agg(F.min(priority("b")).alias("m"))
        best = best.select(F.col("a").alias("old"), F.least(F.col("m"), priority("a"))["id"].alias("new"))
        best = written(best, f"{name}-step")
        labels = written(
            labels.join(best, labels["root"] == best["old"], "left")
            .select("node", F.coalesce("new", "root").alias("root")), f"{name}-labels")
        for end in ("a", "b"):
            edges = edges.join(best, edges[end] == best["old"]).drop(end, "old").withColumnRenamed("new", end)
        edges = written(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            f"{name}-edges")
    return labels
