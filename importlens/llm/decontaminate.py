r"""Benchmark decontamination: MinHash containment search, then exact containment.

Words are runs of letters, marks and digits of the lower-cased whole text;
shingles are five of them (an item of fewer words is one shingle of all its
words). A document contains an item when it holds at least ``similarity`` of
the item's distinct shingles.

A short item inside a long document has a tiny Jaccard similarity, so the sketch
is taken of the item only and looked up in the whole document. Items are
partitioned by size (powers of two). A document that contains an item of ``n``
shingles lacks at most ``n - ceil(similarity * n)`` of them, so of one more
than that many shingles it holds at least one; each partition takes its bound's
number of the item's smallest hash values, and no containment is missed. The
items found that way are then verified by exact shingles of the text.

The sketch grows with the benchmark, not with the corpus; Spark broadcasts it
only under its own size threshold and shuffles otherwise.

Defined results: null and empty texts contain nothing, and items without words
take no part. The query and ``remove_contaminated`` decide for each row by its own
text: rows that share an id, or have none, are told apart by a hash of the text
(``by_row``), and rows that repeat id and text count once. ``contained_items`` itself
takes rows of one key as one text, and a null key as a key like any other; rows that
repeat an ``item_id`` are one item. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from importlens.llm.common import same_key, table, written

SHINGLE_WORDS, SIMILARITY = 5, 0.8


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text.cast("string")), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _windows(items: Column, width: int, make) -> Column:
    """``make(array, position)`` for every run of ``width`` items; the array is evaluated once."""
    def runs(a):
        positions = F.sequence(F.lit(0), F.size(a) - width)
        return F.when(F.size(a) >= width, F.transform(positions, lambda i: make(a, i)))
    return F.transform(F.array(items), runs)[0]


def text_shingles(words: Column, width: int) -> Column:
    return _windows(words, width, lambda a, i: F.array_join(F.slice(a, i + 1, width), " "))


def hashed_shingles(words: Column, width: int) -> Column:
    """Each word is hashed once; a shingle's value is the hash of its words' hashes."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _windows(hashes, width, lambda a, i: F.xxhash64(*[F.get(a, i + j) for j in range(width)]))


def sketches(items: DataFrame, similarity: float) -> DataFrame:
    """Rows ``(item_id, h)``: the smallest hash values of each item, as many as its size partition asks."""
    bound = F.pow(F.lit(2), F.length(F.bin(F.col("n")))).cast("long")  # sizes of a partition lie under this power of two
    take = F.least(F.col("n"), bound - F.ceil(F.lit(similarity) * bound) + 1)
    order = Window.partitionBy("item_id").orderBy("h")
    ranked = items.withColumn("r", F.row_number().over(order))
    return ranked.where(F.col("r") <= take).select("item_id", "h")


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS,
                    similarity: float = SIMILARITY) -> DataFrame:
    """Rows ``(doc_id, item_id, n_shingles, matched, containment)`` of all contained items."""
    texts = benchmark.select("item_id", words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    widths = sorted(r[0] for r in texts.select(F.least(F.size("w"), F.lit(width))).distinct().collect())  # <= width values
    parts = [texts.where(F.least(F.size("w"), F.lit(width)) == k).select(
        "item_id", F.explode(F.arrays_zip(text_shingles(F.col("w"), k).alias("s"),
                                          hashed_shingles(F.col("w"), k).alias("h"))).alias("x")) for k in widths or [width]]
    shingles = parts[0]
    for part in parts[1:]:
        shingles = shingles.union(part)
    shingles = shingles.select("item_id", "x.s", "x.h").distinct()
    sizes = shingles.groupBy("item_id").agg(F.count("*").alias("n"))
    items = written(same_key(shingles, sizes, "item_id", "inner"), "benchmark-shingles")
    sketch = written(sketches(items, similarity), "benchmark-sketches")

    def corpus(rows: DataFrame, make) -> DataFrame:
        grams = [F.coalesce(make(F.col("w"), k), F.array()) for k in widths or [width]]
        rows = rows.select("doc_id", words_of(F.col("text")).alias("w"))
        return rows.select("doc_id", F.explode(F.array_distinct(F.concat(*grams))).alias("g"))

    hits = corpus(docs, hashed_shingles).join(sketch, F.col("g") == F.col("h")).select("doc_id", "item_id").distinct()
    hits = written(hits, "containment-candidates")
    suspects = same_key(docs.select("doc_id", "text"), hits.select("doc_id").distinct(), "doc_id", "left_semi")
    found = corpus(suspects, text_shingles).join(items, F.col("g") == F.col("s"))
    found = found.groupBy("doc_id", "item_id").agg(F.countDistinct("s").alias("matched"), F.max("n").alias("n_shingles"))
    found = found.where(F.col("matched") >= F.lit(similarity) * F.col("n_shingles"))
    other = hits.select(F.col("doc_id").alias("d"), F.col("item_id").alias("i"))
    found = found.join(other, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("item_id").eqNullSafe(F.col("i")), "left_semi")
    return found.select("doc_id", "item_id", "n_shingles", "matched",
                        (F.col("matched") / F.col("n_shingles")).alias("containment"))


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with ``doc_id`` made of the id and a hash of the text: rows of one id (or of none) are told apart."""
    own = F.struct(docs["doc_id"].alias("id"), F.xxhash64(docs["text"]).alias("hash"))
    return docs.select(own.alias("doc_id"), "text")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS,
                        similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose own text contains no item."""
    found = contained_items(by_row(docs), benchmark, width, similarity)
    found = written(found.select("doc_id.id", "doc_id.hash").distinct(), "contaminated")
    same = docs["doc_id"].eqNullSafe(found["id"]) & (F.xxhash64(docs["text"]) == found["hash"])
    return docs.join(found, same, "left_anti")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in the documents, with their exact containment; each text of an id counts for itself."""
    found = contained_items(by_row(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
    return found.withColumn("doc_id", F.col("doc_id.id"))


ORACLE = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM benchmark),
item_grams AS (
  SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM (SELECT item_id, w, least(len(w), 5) AS k FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT item_id, count(*) AS n FROM item_grams GROUP BY item_id),
doc_words AS (
  SELECT DISTINCT doc_id, md5(text) AS t, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents),
doc_grams AS (
  SELECT DISTINCT doc_id, t, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s
  FROM doc_words, (SELECT DISTINCT k FROM item_grams) WHERE len(w) >= k)
SELECT doc_id, item_id, n AS n_shingles, count(*) AS matched, count(*)::DOUBLE / n AS containment
FROM doc_grams JOIN item_grams USING (k, s) JOIN sizes USING (item_id)
GROUP BY doc_id, t, item_id, n HAVING count(*) >= 0.8 * n
"""
