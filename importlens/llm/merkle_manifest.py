"""Merkle manifest of a dataset, kept as postorder append logs.

A *tree* orders its leaves and hashes runs of ``FANOUT`` neighbours until one
node is left; a node is the lower-case hex SHA-256 of its children's hex digests
(a run of one is hashed too, a tree of one leaf is that leaf). The manifest has
one tree a source and one over the sources' subroots.

Leaves get their place by a distributed numbering, so a source with most of the
rows is spread like any other. Aligned builders, each for ``FANOUT ** HEIGHT``
neighbouring leaves, append every node to their segment when it is complete:
leaves, and a parent right after its last child. Segment ``b`` of a tree is thus
the run of its log from record ``b * FULL`` on. The segments' top nodes are the
leaves of the next *tier*, which has a ``FANOUT ** HEIGHT``-th of the rows, until
every tree is one segment. A node's record is found in closed form from the
sizes of the subtrees before it (``record``), which is how a proof reads its
siblings: from the segment of the leaf, then from one segment in each tier above.

Proofs go down the tiers: each segment receives the path above its top, and adds
its own. Only a bounded segment meets its own leaves in a task.

Defined results: a null field is the mark ``-``, an empty text ``0:``. Null ids
come first in their source, rows of equal id by their leaf; repeated rows have
equal leaves and neighbouring places. A null source is a source of its own, before
the empty one. No documents: no rows. Extra columns are ignored. Very long texts are hashed
by Spark's own ``sha2`` and leave the job with the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import counted_broadcast, table, written
from importlens.operators.order import running

FANOUT, HEIGHT, TAMPER_EVERY = 16, 3, 5
CAPACITY = FANOUT ** HEIGHT                                     # leaves of a full segment
FULL = sum(FANOUT ** k for k in range(HEIGHT + 1))              # its records
TOP_TREE = "top"                                                # the tree over the subroots


def node(digests: list[str]) -> str:
    return sha256("".join(digests).encode()).hexdigest()


class Builder:
    """Appends digests and, as soon as a run is full, its parent."""

    def __init__(self) -> None:
        self.log: list[str] = []
        self.open: list[list[str]] = [[]]

    def add(self, digest: str, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
        self.log.append(digest)
        self.open[level].append(digest)
        if len(self.open[level]) == FANOUT:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        self.add(node(run), level + 1)

    def finish(self, height: int | None = None) -> str:
        """Close the open runs up to ``height``, or until a single node is left; the top node."""
        level = 0
        while True:
            last = level == len(self.open) - 1
            if last and (level == height if height is not None else len(self.open[level]) == 1):
                return self.open[level][0]
            if self.open[level]:
                self._close(level)
            level += 1


def widths(leaves: int, height: int | None = None) -> list[int]:
    """Nodes on each level over ``leaves`` leaves."""
    out = [leaves]
    while out[-1] > 1 if height is None else len(out) <= height:
        out.append(-(-out[-1] // FANOUT))
    return out


def record(level: int, index: int, leaves: int, height: int) -> int:
    """Record of a node in its segment's log, counted from the sizes of the subtrees complete before it."""
    start = index * FANOUT ** level
    end = min(start + FANOUT ** level, leaves)
    below = sum(-(-end // FANOUT ** k) for k in range(level + 1))
    return below + sum(start // FANOUT ** k for k in range(level + 1, height + 1)) - 1


class Segment:
    """A log read by address."""

    def __init__(self, nodes: bytes, leaves: int, tall: bool) -> None:
        self.nodes, self.leaves = nodes, leaves
        self.widths = widths(leaves, HEIGHT if tall else None)

    def digest(self, level: int, index: int) -> str:
        at = 32 * record(level, index, self.leaves, len(self.widths) - 1)
        return self.nodes[at:at + 32].hex()

    def run(self, level: int, first: int) -> list[str]:
        return [self.digest(level, i) for i in range(first, min(first + FANOUT, self.widths[level]))]

    def path(self, index: int, level: int = 0) -> list[tuple[str, str]]:
        """Siblings (left, right) of the node's run on each level, up to the segment's top."""
        out = []
        for at in range(level, len(self.widths) - 1):
            own = index // FANOUT ** (at - level)
            first = own - own % FANOUT
            run = self.run(at, first)
            out.append(("".join(run[:own - first]), "".join(run[own - first + 1:])))
        return out


def packed(path: list[tuple[str, str]]) -> bytes:
    """Two counts a level, then its digests."""
    return b"".join(bytes((len(a) // 64, len(b) // 64)) + bytes.fromhex(a + b) for a, b in path)


def unpacked(data: bytes) -> list[tuple[str, str]]:
    out, at = [], 0
    while at < len(data):
        a, b = data[at], data[at + 1]
        digests = data[at + 2:at + 2 + 32 * (a + b)].hex()
        out.append((digests[:64 * a], digests[64 * a:]))
        at += 2 + 32 * (a + b)
    return out


def folded(digest: str, path: list[tuple[str, str]]) -> str:
    """Root from a leaf and its siblings."""
    for left, right in path:
        digest = sha256((left + digest + right).encode()).hexdigest()
    return digest


# ------------------------------------------------------------------ building ----

def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``(tree, block, tall, digest)``; one segment is open at a time."""
    key, builder, leaves = None, Builder(), 0
    for batch in batches:
        done = []
        for tree, block, tall, digest in zip(*[batch[c].to_pylist() for c in ("tree", "block", "tall", "digest")]):
            if (tree, block, tall) != key:
                if key is not None:
                    done.append((key, builder, leaves))
                key, builder, leaves = (tree, block, tall), Builder(), 0
            builder.add(digest.hex())
            leaves += 1
        yield _segment_rows(done)
    if key is not None:
        yield _segment_rows([(key, builder, leaves)])


def _segment_rows(done: list) -> pa.RecordBatch:
    tops = [bytes.fromhex(b.finish(HEIGHT if key[2] else None)) for key, b, _ in done]
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k, _, _ in done], pa.string()), pa.array([k[1] for k, _, _ in done], pa.int64()),
         pa.array([k[2] for k, _, _ in done], pa.bool_()), pa.array([n for _, _, n in done], pa.int32()),
         pa.array([bytes.fromhex("".join(b.log)) for _, b, _ in done], pa.binary()), pa.array(tops, pa.binary())],
        ["tree", "block", "tall", "leaves", "nodes", "top"])


def segments(leaves: DataFrame) -> DataFrame:
    """One tier: ``(tree, block, tall, leaves, nodes, top)`` from written rows ``(tree, index, digest)``.

    ``tall`` trees have further segments, and all their segments reach the full height.
    """
    tall = written(leaves.where(F.col("index") >= CAPACITY).select("tree").distinct(), "merkle-tall")
    rows = leaves.join(counted_broadcast(tall.withColumn("tall", F.lit(True))), "tree", "left").select(
        "tree", F.floor(F.col("index") / CAPACITY).alias("block"), "index", F.coalesce("tall", F.lit(False)).alias("tall"), "digest")
    spread = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
    return spread.mapInArrow(_build, "tree string, block long, tall boolean, leaves int, nodes binary, top binary")


def append_log(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The written tiers over rows ``(tree, index, digest)``; a tree's last segment is not ``tall``."""
    tiers = [written(segments(leaves), f"{name}-0")]
    while not (above := tiers[-1].where("tall")).isEmpty():
        rows = above.select("tree", F.col("block").alias("index"), F.col("top").alias("digest"))
        tiers.append(written(segments(rows), f"{name}-{len(tiers)}"))
    return tiers


def subroots(tiers: list[DataFrame]) -> DataFrame:
    """``(tree, top)`` of every tree."""
    tops = [t.where("not tall").select("tree", "top") for t in tiers]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


# -------------------------------------------------------------------- proofs ----

def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path above each child of a segment: rows ``(tree, block, above)``."""
    for batch in batches:
        for tree, block, tall, leaves, nodes, above in zip(
                *[batch[c].to_pylist() for c in ("tree", "block", "tall", "leaves", "nodes", "above")]):
            segment = Segment(nodes, leaves, tall)
            paths = [packed(segment.path(i)) + above for i in range(leaves)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * leaves, pa.string()), pa.array(range(block * CAPACITY, block * CAPACITY + leaves), pa.int64()),
                 pa.array(paths, pa.binary())], ["tree", "block", "above"])


def path_above(tiers: list[DataFrame], last: DataFrame, name: str) -> DataFrame:
    """``(tree, block, above)`` for the segments of the lowest tier, from ``last``, ``(tree, above)`` of the trees' tops."""
    found = None
    for k in range(len(tiers) - 1, -1, -1):
        own = tiers[k].where("not tall").join(last, "tree").select("tree", "block", "above")
        found = own if found is None else own.unionByName(found)
        if k:
            rows = tiers[k].join(found, ["tree", "block"])
            found = written(rows.mapInArrow(_descend, "tree string, block long, above binary"), f"{name}-above")
    return found


@dataclass
class Manifest:
    """Written tiers of the trees of the sources and of the tree over them, with the root."""

    trees: list[DataFrame]
    top: list[DataFrame]
    names: DataFrame        # (tree, index, digest) of the subroots

    def root(self) -> DataFrame:
        """``(root)``, one row, or none without documents."""
        return subroots(self.top).select(F.col("top").alias("root"))

    def above(self) -> DataFrame:
        """``(tree, block, above)``: the path from each lowest segment's top to the root."""
        empty = self.top[-1].select("tree").distinct().withColumn("above", F.lit(b""))
        up = written(path_above(self.top, empty, "merkle-top"), "merkle-top-above")
        rows = self.top[0].join(up, ["tree", "block"]).mapInArrow(_descend, "tree string, block long, above binary")
        paths = written(rows.select(F.col("block").alias("index"), "above"), "merkle-subroot-above")
        last = self.names.join(paths, "index").select(F.col("name").alias("tree"), "above")
        return path_above(self.trees, written(last, "merkle-tree-above"), "merkle")


def manifest(leaves: DataFrame) -> Manifest:
    """Build the logs over written leaves ``(tree, index, digest)``; trees are ordered by name, bytewise."""
    trees = append_log(leaves, "merkle-tree")
    tops = written(subroots(trees), "merkle-subroots")
    names = running(tops, ["tree"]).select(
        F.lit(TOP_TREE).alias("tree"), (F.col("position") - 1).alias("index"), F.col("top").alias("digest"), F.col("tree").alias("name"))
    names = written(names, "merkle-names")
    return Manifest(trees, append_log(names.drop("name"), "merkle-top"), names)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's row, then its leaves in order: the proof digest and folded root of each leaf."""
    segment, offset, first, run, upper, rest = None, 0, -1, [], [], ""
    for batch in batches:
        keep, proofs, roots = [], [], []
        columns = [batch[c].to_pylist() for c in ("index", "block", "tall", "leaves", "nodes", "above", "shown")]
        for row, (index, block, tall, leaves, nodes, above, shown) in enumerate(zip(*columns)):
            if nodes is not None:
                segment, offset, first = Segment(nodes, leaves, tall), block * CAPACITY, -1
                tail = unpacked(above)
                continue
            own = index - offset
            if first < 0 or not first <= own < first + FANOUT:
                first = own - own % FANOUT
                if len(segment.widths) > 1:
                    run, upper = segment.run(0, first), segment.path(first // FANOUT, 1) + tail
                else:
                    run, upper = [], tail
                rest = "".join(a + b for a, b in upper)
            left, right = "".join(run[:own - first]), "".join(run[own - first + 1:])
            path = [(left, right)] + upper if run else upper
            keep.append(row)
            proofs.append(sha256((left + right + rest).encode()).hexdigest())
            roots.append(folded(shown.hex(), path))
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["tree"].take(at), batch["doc_id"].take(at), batch["digest"].take(at),
             pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
            ["tree", "doc_id", "digest", "proof_sha256", "folded_root"])


def proved(leaves: DataFrame, built: Manifest) -> DataFrame:
    """``leaves`` ``(tree, index, doc_id, digest, shown)`` with the digest of their proof and the root folded from ``shown``."""
    kind = leaves.schema["doc_id"].dataType.simpleString()
    block = F.floor(F.col("index") / CAPACITY)
    none = F.lit(None)
    heads = built.trees[0].join(built.above(), ["tree", "block"]).select(
        "tree", "block", F.lit(-1).cast("long").alias("index"), none.cast(kind).alias("doc_id"), none.cast("binary").alias("digest"),
        none.cast("binary").alias("shown"), "tall", "leaves", "nodes", "above")
    rows = leaves.select("tree", block.alias("block"), "index", "doc_id", "digest", "shown", none.cast("boolean").alias("tall"),
                         none.cast("int").alias("leaves"), none.cast("binary").alias("nodes"), none.cast("binary").alias("above"))
    spread = heads.unionByName(rows).repartition("tree", "block").sortWithinPartitions("tree", "block", "index")
    return spread.mapInArrow(_prove, f"tree string, doc_id {kind}, digest binary, proof_sha256 string, folded_root string")


# --------------------------------------------------------------------- query ----

def field(c: str | Column) -> Column:
    """``-`` for a null, else the UTF-8 byte count, ``:`` and the value."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def document_leaf(text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(field("doc_id"), field("source"), field("lang"), field("n_chars"), field(text)), 256))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Written rows ``(tree, index, doc_id, digest, shown)``; ``shown`` is the leaf of the tampered row, if it is one."""
    upper = "".join(chr(c) for c in range(ord("A"), ord("Z") + 1))
    text = F.col("text").cast("string")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0, F.lit(False))
    rows = docs.select(
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("source").cast("string"))).alias("tree"),
        "doc_id", document_leaf(text).alias("digest"),
        F.when(tampered, document_leaf(F.translate(text, upper, upper.lower()))).alias("shown"))
    placed = running(written(rows, "merkle-rows"), ["doc_id", "digest"], ["tree"])
    return written(placed.select("tree", (F.col("position") - 1).alias("index"), "doc_id", "digest",
                                 F.coalesce("shown", "digest").alias("shown")), "merkle-leaves")


def documents_proved(docs: DataFrame) -> DataFrame:
    """Per document: leaf, subroot, root, digest of its proof, the root folded from the shown leaf, and whether they agree."""
    leaves = document_leaves(docs)
    built = manifest(leaves.select("tree", "index", "digest"))
    tops = built.names.select(F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"))
    root = F.lower(F.hex(built.root().scalar()))
    out = proved(leaves, built).join(counted_broadcast(tops), "tree").withColumn("root", root)
    return out.select("doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, subroot, root and verified proof of every document."""
    return documents_proved(table(spark, sf_dir, "documents"))
