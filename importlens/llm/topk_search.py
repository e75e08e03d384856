"""Exact top-k inner products by best-first search in M-trees.

The rows are dealt into shards of about ``SHARD_ROWS`` distinct vectors; every
shard is one M-tree. Inner products are no metric, so a vector ``x`` is lifted by
one coordinate, ``sqrt(M - x.x)`` with ``M`` the shard's largest ``x.x``; a query
is lifted by zero. Then the squared Euclidean distance is ``q.q + M - 2 q.x``,
and the nearest lifted vectors are those of largest product.

A node is a page of entries. An entry stores its distance to the node's pivot
and, if it stands for a subtree, that subtree's covering radius. A search takes
pages from a queue in the order of the least distance that they may hold. The
stored distances bound an entry's distance by the triangle inequality, so most
are dropped without computing it. Products are computed on integers, ties go to
the smaller id, and pages that may hold a tie are opened: results are exact.

All copies of a vector have the same products, so ``k + 1`` smallest ids of each
distinct vector are enough for any query (its own id may be one of them). The
query set is written to the shared folder; each shard's task reads it there in
blocks and gives ``k`` rows a query, which are merged by query.

Defined results: vectors that are null or hold null or non-finite components and
rows with a null id take no part. Vectors meet only those of their own length;
an empty one has product 0 with another. Rows that repeat an id and vector count
once; an id with several vectors counts by its best product. Extra columns are
ignored. Components are expected to stay below 2 ** 27 in size, so that products
fit 64 bits.
"""

from __future__ import annotations

import heapq
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from importlens.llm.common import shared_uri, table, written
from importlens.session import work_dir

SHARD_ROWS, PAGE, FANOUT, QUERY_BLOCK = 16384, 128, 16, 512
SCALE, TOP, QUERY_EVERY = 256, 5, 50


class MTree:
    """An M-tree over distinct integer vectors, loaded top down."""

    def __init__(self, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        self.x = vectors.astype(np.int64)
        squares = (self.x * self.x).sum(axis=1)
        self.most = int(squares.max(initial=0))
        self.lifted = np.hstack([self.x.astype(np.float64), np.sqrt((self.most - squares).astype(np.float64))[:, None]])
        self.starts, self.ends, self.leaf = [], [], []
        self.item, self.radius, self.to_parent, self.child = [], [], [], []
        self.computed = 0
        #: subtrees still to load: their node, their vectors and their pivot
        waiting = [(self._node(), np.arange(len(self.x)), -1)]
        while waiting:
            node, rows, pivot = waiting.pop()
            self.starts[node] = len(self.item)
            self.leaf[node] = len(rows) <= page
            if self.leaf[node]:
                self._entries(rows, np.zeros(len(rows)), pivot, [-1] * len(rows))
            else:
                parts = self._split(rows, fanout)
                pivots = np.array([p for p, _, _ in parts])
                nodes = [self._node() for _ in parts]
                self._entries(pivots, np.array([r for _, _, r in parts]), pivot, nodes)
                waiting += [(n, own, p) for n, (p, own, _) in zip(nodes, parts)]
            self.ends[node] = len(self.item)
        self.item, self.child = np.array(self.item, dtype=np.int64), np.array(self.child, dtype=np.int64)
        self.radius, self.to_parent = np.array(self.radius), np.array(self.to_parent)

    def _node(self) -> int:
        for values in (self.starts, self.ends, self.leaf):
            values.append(0)
        return len(self.starts) - 1

    def _distances(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        return np.sqrt(((self.lifted[rows] - self.lifted[pivot]) ** 2).sum(axis=1))

    def _entries(self, rows: np.ndarray, radius: np.ndarray, pivot: int, nodes: list[int]) -> None:
        self.item += rows.tolist()
        self.radius += radius.tolist()
        self.to_parent += (self._distances(rows, pivot) if pivot >= 0 else np.zeros(len(rows))).tolist()
        self.child += nodes

    def _split(self, rows: np.ndarray, fanout: int) -> list[tuple[int, np.ndarray, float]]:
        """Pivots far from each other, the vectors nearest to each, and the covering radii."""
        nearest, owner, pivots = np.full(len(rows), np.inf), np.zeros(len(rows), dtype=np.int64), []
        far = 0
        for n in range(fanout):
            pivots.append(int(rows[far]))
            d = self._distances(rows, pivots[-1])
            closer = d < nearest
            nearest[closer], owner[closer] = d[closer], n
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break
        if len(pivots) == 1:    # lifted values that floating point can't tell apart: cut in two
            half = len(rows) // 2
            return [(int(own[0]), own, float(self._distances(own, int(own[0])).max())) for own in (rows[:half], rows[half:])]
        return [(p, rows[owner == n], float(nearest[owner == n].max(initial=0))) for n, p in enumerate(pivots)]

    def search(self, query: np.ndarray, k: int, ids_of) -> list[tuple[int, int]]:
        """The ``k`` best ``(-product, id)``, ascending; ``ids_of(row)`` gives the ids of a vector."""
        q = query.astype(np.int64)
        base = float(q @ q) + self.most
        slack = 1e-7 * (1 + base) ** 0.5
        best: dict[int, int] = {}           # the best product of each of the best ids
        limit, floor = np.inf, None
        queue = [(0.0, 0, -1.0)]
        while queue:
            least, node, at_pivot = heapq.heappop(queue)
            if least > limit + slack:
                break
            span = slice(self.starts[node], self.ends[node])
            rows, radius, child = self.item[span], self.radius[span], self.child[span]
            if at_pivot >= 0 and limit < np.inf:
                possible = np.abs(at_pivot - self.to_parent[span]) - radius <= limit + slack
                rows, radius, child = rows[possible], radius[possible], child[possible]
            if not len(rows):
                continue
            products = self.x[rows] @ q
            self.computed += len(rows)
            if self.leaf[node]:
                for at in np.argsort(-products, kind="stable").tolist():
                    product = int(products[at])
                    if floor is not None and product < floor:
                        break
                    for i in ids_of(int(rows[at])):
                        best[i] = max(best.get(i, product), product)
                    if len(best) > k or floor is None and len(best) == k:
                        best = dict(sorted(best.items(), key=_rank)[:k])
                        floor = min(best.values())
                if floor is not None:
                    limit = max(0.0, base - 2 * floor) ** 0.5
            else:
                distance = np.sqrt(np.maximum(0, base - 2 * products))
                for d, r, c in zip(distance.tolist(), radius.tolist(), child.tolist()):
                    if d - r <= limit + slack:
                        heapq.heappush(queue, (max(least, d - r), c, d))
        return sorted((-p, i) for i, p in best.items())


def _rank(found: tuple[int, int]) -> tuple[int, int]:
    """Order of ``(id, product)``: largest product first, then the smaller id."""
    return -found[1], found[0]


def integer_vectors(rows: DataFrame, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """Rows ``(vec_id, v)``: ``floor(scale * x)`` of the vectors that take part."""
    value = F.col(column)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & value.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(value, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def _blocks(path: str) -> Iterator[tuple[np.ndarray, list]]:
    files, folder = pafs.FileSystem.from_uri(path)
    for batch in ds.dataset(folder, filesystem=files, format="parquet").to_batches(batch_size=QUERY_BLOCK):
        yield batch["vec_id"].to_numpy(zero_copy_only=False), batch["v"].to_pylist()


def _search_shard(batches: Iterator[pa.RecordBatch], path: str, k: int) -> Iterator[pa.RecordBatch]:
    """Build the M-trees of one shard (one for each vector length) and search all queries, block by block."""
    ids: dict[int, list[list[int]]] = {}
    vectors: dict[int, list[list[int]]] = {}
    for batch in batches:
        for own, v in zip(batch["ids"].to_pylist(), batch["v"].to_pylist()):
            ids.setdefault(len(v), []).append(own)
            vectors.setdefault(len(v), []).append(v)
    trees = {n: MTree(np.array(v, dtype=np.int64).reshape(len(v), n)) for n, v in vectors.items()}
    if not trees:
        return
    for query_ids, queries in _blocks(path):
        found = []
        for query_id, q in zip(query_ids.tolist(), queries):
            if len(q) in trees:
                own = ids[len(q)]
                best = trees[len(q)].search(np.array(q, dtype=np.int64), k, lambda row: [i for i in own[row] if i != query_id])
                found += [(query_id, i, -p) for p, i in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], pa.int64()) for c in range(3)],
                                         ["query_id", "vec_id", "score"])


def top_products(vectors: DataFrame, queries: Column, k: int = TOP, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the ``k`` best other rows of each row of ``vectors`` that ``queries`` picks."""
    spark = vectors.sparkSession
    path = work_dir(spark, "topk-queries")
    vectors.where(queries).select("vec_id", "v").distinct().write.parquet(path)
    path = shared_uri(spark, path)
    order = Window.partitionBy("v").orderBy("vec_id")
    # the limit also applies before the shuffle, so copies of one vector send few rows
    ranked = vectors.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1)
    classes = written(ranked.groupBy("v").agg(F.collect_list("vec_id").alias("ids")), "topk-vectors")
    shards = max(1, -(-classes.count() // shard_rows))
    rows = classes.repartition(shards, "v")
    found = rows.mapInArrow(lambda batches: _search_shard(batches, path, k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vector among all others."""
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_products(vectors, F.col("vec_id") % QUERY_EVERY == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_inner_product(q.v, e.v)::BIGINT AS score
  FROM e AS q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v)
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
