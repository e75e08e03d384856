"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints are 64-bit majority votes over word shingles. Two fingerprints
are linked when they differ in at most ``radius`` bits. Every bit position gets
a nonzero vector of ``radius + 1`` bits; each nonzero vector ``v`` of that space
defines one table, whose mask keeps the positions with odd inner product with
``v``. At most ``radius`` differing positions span less than the space, so some
``v`` is orthogonal to all of them: that table's key ignores every differing
bit, and the pair collides. No pair within the radius is missed.

Inside a bucket no pairs are listed. A bucket of two is one comparison of its
smallest and largest member. In a larger bucket each member is written under
every value at most ``radius / 2`` flips away (flips outside the mask only);
members that meet there are within the radius, and each links to the smallest
of them. That keeps the rows in proportion to the fingerprints.

Defined results: null and empty texts, and texts without words, have the
fingerprint zero and link like any other. Repeated rows give repeated results.
A null ``doc_id`` takes part; ``component_id`` is the smallest non-null id of
the group (null if there is none). Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from importlens.llm.common import arrow_pass, components, table, written

BITS, SHINGLE_WORDS, RADIUS, HASH_SEED = 64, 3, 2, 42


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned fingerprint of a whole text: a bit is set if over half the shingle hashes have it."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    joined, ends = b" ".join(tokens), np.cumsum([len(t) + 1 for t in tokens]) - 1
    width = min(words, len(tokens))
    stops = ends[width - 1:].tolist()
    starts = [0, *(ends[: len(tokens) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)], dtype="<u8")
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batch: pa.RecordBatch, words: int) -> pa.RecordBatch:
    prints = np.array([fingerprint(t, words) for t in batch["text"].to_pylist()], dtype=np.uint64)
    return pa.RecordBatch.from_arrays([batch["doc_id"], batch["text_hash"], pa.array(prints.view(np.int64))],
                                      ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """Rows ``(doc_id, text_hash, fp)``; ``fp`` is the fingerprint's bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))
    return arrow_pass(rows, partial(_fingerprints, words=words), "doc_id long, text_hash long, fp long")


def covering_masks(radius: int = RADIUS, seed: int = 7) -> list[int]:
    """The ``2 ** (radius + 1) - 1`` masks; position vectors are dealt evenly in a seeded order."""
    space = (1 << (radius + 1)) - 1
    vectors = np.random.default_rng(seed).permutation([1 + i % space for i in range(BITS)])
    return [sum(1 << i for i, m in enumerate(vectors.tolist()) if (m & v).bit_count() % 2) for v in range(1, space + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _ball(mask: int, flips: int):
    """All exclusive-or values with at most ``flips`` bits outside ``mask``."""
    free = [1 << i for i in range(BITS) if not mask >> i & 1]
    return F.array(*[F.lit(_signed(sum(c))).cast("long") for n in range(flips + 1) for c in combinations(free, n)])


def covering_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect exactly the pairs within the radius."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be even")  # a hub joins members half the radius away
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
        for t, m in enumerate(masks)])).alias("k")).select("fp", "k.t", "k.key")
    keyed = written(keyed, "covering-keys")
    buckets = keyed.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    buckets = written(buckets.where("n > 1"), "covering-buckets")
    pairs = buckets.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    ball = F.when(F.col("t") == 0, _ball(masks[0], radius // 2))
    for t, m in enumerate(masks[1:], 1):
        ball = ball.when(F.col("t") == t, _ball(m, radius // 2))
    crowded = keyed.join(buckets.where("n > 2").select("t", "key"), ["t", "key"], "left_semi")
    meeting = crowded.select("t", "fp", F.explode(ball).alias("flip")).select(
        "t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    # a meeting point holds at most the members of one ball, a fixed number
    first = F.min("fp").over(Window.partitionBy("t", "at"))
    stars = meeting.select(first.alias("a"), F.col("fp").alias("b")).where("a <> b")
    return pairs.union(stars).distinct()


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Rows ``(doc_id, text_hash, fp, root, component_id)``, one per row of ``docs``; ``root`` names the group."""
    prints = written(fingerprints(docs, words), "simhash-prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    labels = components(covering_links(classes.select("fp"), radius), "simhash")
    rooted = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("fp", "root", "component_id"), "simhash-named")
    return prints.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group one row with the smallest ``doc_id``.

    Where several rows of the group carry that id, the text of smallest hash
    stays, and of rows that repeat id and text one stays.
    """
    groups = simhash_groups(docs, words, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = groups.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    kept = rows.groupBy("root").agg(F.min(F.struct("text_hash", "doc_id", "n")).alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("__id"), F.col("k.text_hash").alias("__hash"), F.col("k.n").alias("__n"))
    kept = written(kept, "simhash-kept")
    out = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["__id"])
                    & (F.xxhash64(docs["text"]) == kept["__hash"]))
    repeated = out.where("__n > 1").dropDuplicates(["__id", "__hash"])
    return out.where("__n = 1").unionByName(repeated).select(*docs.columns)


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: ``doc_id, fingerprint, component_id``."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
