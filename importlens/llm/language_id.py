"""Hierarchical language identification: family first, then one-versus-one linear SVMs.

A whole text is lower-cased, runs of other characters than letters become one
space, and its 1- to 3-grams of characters are counted in ``buckets`` hashed
bins. The feature vector is the square root of the relative counts (length 1).
One linear support vector machine per language family (against the rest) picks
the family; inside it, a machine for each pair of its languages votes, ties go
to the larger sum of margins and then to the smaller language value.

Training uses a bounded sample (about ``TRAIN_ROWS``, shared evenly by the
languages, the rows of smallest hash of ``doc_id``) of the labelled rows outside the held-out
part; everything else sees every row and every character.

``score`` is the product of the family's and the language's confidence
(logistic functions of the margins), between 0 and 1.

Defined results: a null text or one without a letter is ``und`` with score 0,
and so is every text when no row can be learned from. Rows with a null
``doc_id`` are predicted, never learned from, and not held out. Repeated rows
give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import arrow_pass, counted_broadcast, table, written

BUCKETS, TRAIN_ROWS, CHUNK = 4096, 2000, 1 << 18
FOLDS, HELD_OUT_FOLD, UNKNOWN = 4, 2, "und"
#: Documents with a lower score are rejected by the pipeline's stage. On the 249 held-out documents with a
#: letter of sf0.01 the least score is 0.565; texts in no learned language and junk get 0.31 to 0.40.
MIN_SCORE = 0.5

#: Language families by ISO 639-1 code. Languages that are not listed form one family.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "greek": "el",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "iranian": "fa ku ps tg",
    "indic": "bn gu hi mr ne pa si ur",
    "dravidian": "kn ml ta te",
    "east asian": "ja ko zh",
    "malayic": "id jv ms tl",
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang.lower().split("-")[0] in codes.split()), "other")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str | None, buckets: int = BUCKETS) -> np.ndarray | None:
    """Hashed counts of the 1- to 3-grams of a whole text; None if it has no letter."""
    counts, tail, seen = np.zeros(buckets, dtype=np.int64), np.zeros(0, dtype=np.uint32), False
    lowered = (text or "").lower()
    for at in range(0, len(lowered), CHUNK):
        codes = np.frombuffer(lowered[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letters = _letters()[codes]
        seen = seen or bool(letters.any())
        codes = np.where(letters, codes, 32).astype(np.uint32)
        start = len(tail)
        codes = np.concatenate([tail, codes])
        keep = np.ones(len(codes), dtype=bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        kept_before = int(keep[:start].sum())
        codes = codes[keep].astype(np.uint64)
        mixed = codes * np.uint64(0x9E3779B97F4A7C15)
        grams = [mixed[kept_before:]]
        for n in (2, 3):
            mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1:]
            grams.append(mixed[max(0, kept_before - n + 1):])
        for g in grams:
            g = g * np.uint64(0x94D049BB133111EB)
            counts += np.bincount((g >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
        tail = codes[-2:].astype(np.uint32)
    return counts if seen else None


def features(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights (the bias last) of a squared-hinge linear machine, by accelerated gradient steps.

    The classes weigh the same whatever their row counts.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    t, rate = 1.0, np.float32(1 / (4 + penalty))
    for _ in range(steps):
        slack = np.maximum(np.float32(0), 1 - y * (x @ v))
        grad = np.float32(penalty) * v - 2 * ((weight * y * slack) @ x)
        w, before = v - rate * grad, w
        t, last = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        v = w + np.float32((last - 1) / t) * (w - before)
    return w


class Model:
    """Family machines and, by family, the machines of each pair of its languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        names, families = np.array(langs, dtype=object), np.array([family_of(g) for g in langs], dtype=object)
        self.families = sorted(set(families))
        self.langs = {f: sorted(set(names[families == f])) for f in self.families}
        rows, self.first, self.pairs = [], 0, []
        if len(self.families) == 2:    # one machine and its mirror image
            one = linear_svm(x, np.where(families == self.families[0], 1, -1))
            rows += [one, -one]
        elif len(self.families) > 2:
            rows += [linear_svm(x, np.where(families == f, 1, -1)) for f in self.families]
        self.first = len(rows)
        for f in self.families:
            for i, a in enumerate(self.langs[f]):
                for b in self.langs[f][i + 1:]:
                    own = (names == a) | (names == b)
                    rows.append(linear_svm(x[own], np.where(names[own] == a, 1, -1)))
                    self.pairs.append((f, a, b))
        self.weights = np.array(rows, dtype=np.float32).reshape(len(rows), x.shape[1] + 1)

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        family, sure = self.families[0], 1.0
        if self.first:
            best, second = np.argsort(-margins[:self.first], kind="stable")[:2]
            family, sure = self.families[best], _logistic(margins[best] - margins[second])
        votes = {g: [0, 0.0, 1.0] for g in self.langs[family]}
        for (f, a, b), m in zip(self.pairs, margins[self.first:].tolist()):
            if f == family:
                for lang, own in ((a, m), (b, -m)):
                    votes[lang][0] += own > 0 or (own == 0 and lang == a)
                    votes[lang][1] += own
                    votes[lang][2] = min(votes[lang][2], _logistic(2 * own))
        lang = min(votes, key=lambda g: (-votes[g][0], -votes[g][1], g))
        return lang, sure * votes[lang][2]


def _logistic(margin: float, slope: float = 2.0) -> float:
    return float(1 / (1 + np.exp(-min(50.0, max(-50.0, slope * float(margin))))))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def train(docs: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS, buckets: int = BUCKETS) -> Model | None:
    """Fit on about ``rows`` rows (or all, if fewer) of ``docs`` where ``learn_from`` and ``lang`` and ``doc_id`` are not null."""
    labelled = docs.where(learn_from & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    lang = F.col("lang").cast("string")
    sizes = labelled.groupBy(lang.alias("__lang")).agg(F.count("*").alias("__n"))
    sizes = written(sizes, "language-sizes")
    langs = sizes.count()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(g, gram_counts(t, buckets)) for g, t in zip(batch["lang"].to_pylist(), batch["text"].to_pylist())]
        found = [(g, features(c).tobytes()) for g, c in found if c is not None]
        return pa.RecordBatch.from_arrays([pa.array([g for g, _ in found], pa.string()),
                                           pa.array([x for _, x in found], pa.binary())], ["lang", "x"])

    # each language's share of the rows, by the hash of the id
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = labelled.join(counted_broadcast(sizes), lang == F.col("__lang"))
    sample = sample.where(hashed * F.col("__n") * langs < rows).select(
        lang.alias("lang"), F.col("text").cast("string").alias("text"))
    got = sorted((r.lang, bytes(r.x)) for r in arrow_pass(sample, step, "lang string, x binary").collect())
    if not got:
        return None
    return Model(np.array([np.frombuffer(x, dtype=np.float32) for _, x in got]), [g for g, _ in got])


def predict(docs: DataFrame, model: Model | None, buckets: int = BUCKETS) -> DataFrame:
    """Rows ``(doc_id, lang_pred, score)``, one per row of ``docs``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = (None if model is None else gram_counts(t, buckets) for t in batch["text"].to_pylist())
        found = [(UNKNOWN, 0.0) if c is None else model.predict(features(c)) for c in counted]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([g for g, _ in found], pa.string()),
                                           pa.array([s for _, s in found], pa.float64())],
                                          ["doc_id", "lang_pred", "score"])

    return arrow_pass(docs.select("doc_id", F.col("text").cast("string").alias("text")), step,
                      f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def _learnable() -> Column:
    return fold(F.col("doc_id"), FOLDS) != HELD_OUT_FOLD


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` whose language is predicted with at least ``min_score``; same columns."""
    model = train(docs, _learnable())
    if model is None:
        return docs.where(F.lit(False))
    schema, text = docs.schema, docs.columns.index("text")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = [gram_counts(t) for t in batch.column(text).cast(pa.string()).to_pylist()]
        return batch.filter(pa.array([c is not None and model.predict(features(c))[1] >= min_score for c in counted]))

    return arrow_pass(docs, step, schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document: ``doc_id, held_out, lang_pred, score``."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, train(docs, _learnable()))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
