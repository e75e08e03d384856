"""Quality scores: histogram gradient-boosted trees over statistics of whole texts.

The statistics (``FEATURES``) depend on the text alone. They are cut into at
most ``BINS`` bins at training quantiles; each boosting round fits one tree
level by level from histograms of gradients and hessians (logistic loss). The
trees are flattened into arrays (feature, bin, left child, value), and a batch
of rows walks all trees at once by array indexing.

Training uses a bounded sample (about ``TRAIN_ROWS`` ids of smallest hash) of the
labelled documents outside the held-out part. Several labels of one id count by
their mean, at least one half meaning 1; null labels are ignored.

Defined results: null and empty texts have all statistics zero and get a score.
Without any label outside the held-out part every score is 0.5. A null
``doc_id`` is scored and not held out. Repeated rows give repeated results;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from importlens.llm.common import arrow_pass, table, written

TRAIN_ROWS, BINS, ROUNDS, DEPTH, RATE = 8000, 64, 80, 4, 0.15
FOLDS, HELD_OUT_FOLD, ACCEPT = 5, 0, 0.3
SAMPLE_CHARS = 1 << 16

FEATURES = (
    "log_bytes log_words log_lines word_length distinct_words top_word repeated_neighbours "
    "lower upper digits punctuation symbols spaces other_bytes capital_words shouted_words "
    "marked_words pipe_words line_length distinct_lines short_lines ended_lines compressed longest_word").split()


def statistics(text: str | None) -> np.ndarray:
    """The statistics of one whole text, in the order of ``FEATURES``."""
    out = np.zeros(len(FEATURES), dtype=np.float64)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    hist, n = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256), len(raw)
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    count, nw, nl = Counter(words), max(1, len(words)), max(1, len(lines))
    packer = zlib.compressobj(1)
    packed = sum(len(packer.compress(raw[at:at + SAMPLE_CHARS])) for at in range(0, n, SAMPLE_CHARS)) + len(packer.flush())
    upper, lower, digits = hist[65:91].sum(), hist[97:123].sum(), hist[48:58].sum()
    out[:] = (
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), sum(map(len, words)) / nw, len(count) / nw,
        max(count.values(), default=0) / nw, sum(map(str.__eq__, words, words[1:])) / nw,
        lower / n, upper / n, digits / n, hist[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum() / n,
        hist[[35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 96, 123, 124, 125, 126]].sum() / n,
        hist[[9, 10, 13, 32]].sum() / n, hist[128:].sum() / n,
        sum(c for w, c in count.items() if w[0].isupper()) / nw,
        sum(c for w, c in count.items() if len(w) > 1 and w.isupper()) / nw,
        sum(c for w, c in count.items() if not w[-1].isalnum() and w[-1] not in ".,;:") / nw, count["|"] / nw,
        np.log1p(n / nl), len(set(lines)) / nl, sum(len(x) < 30 for x in lines) / nl,
        sum(x.rstrip()[-1] in ".!?\"'" for x in lines) / nl, packed / n, np.log1p(max(map(len, count), default=0)))
    return out


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def document_statistics(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, stats)`` with the statistics as packed 32-bit floats."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = [statistics(t).astype("<f4").tobytes() for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(stats, pa.binary())], ["doc_id", "stats"])

    return arrow_pass(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), step, "doc_id long, stats binary")


class Trees:
    """Boosted trees as flat arrays; node ``k`` of a tree has the children ``left[k]`` and ``left[k] + 1``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE):
        self.depth = depth
        self.cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(mean / (1 - mean)))
        self.feature = np.zeros((rounds, 2 ** (depth + 1)), dtype=np.int16)
        self.bin = np.full(self.feature.shape, BINS, dtype=np.int16)      # a leaf sends every row left, to itself
        self.left = np.tile(np.arange(self.feature.shape[1], dtype=np.int16), (rounds, 1))
        self.value = np.zeros(self.feature.shape, dtype=np.float64)
        bins, margin = self.binned(x), np.full(len(y), self.base)
        for k in range(rounds):
            p = 1 / (1 + np.exp(-margin))
            margin += self._grow(k, bins, p - y, p * (1 - p), rate)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], axis=1).astype(np.int16)

    def _grow(self, k: int, bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, rate: float) -> np.ndarray:
        node, used, open_nodes, l2 = np.zeros(len(bins), dtype=np.int64), 1, [0], 1.0
        for _ in range(self.depth):
            slot = np.full(self.feature.shape[1], -1)
            slot[open_nodes] = np.arange(len(open_nodes))
            rows = np.flatnonzero(slot[node] >= 0)
            at, grown = slot[node[rows]] * BINS, []
            size, best = len(open_nodes) * BINS, [(1e-6, 0, 0)] * len(open_nodes)
            for f in range(bins.shape[1]):
                cell = at + bins[rows, f]
                g = np.bincount(cell, grad[rows], size).reshape(-1, BINS).cumsum(axis=1)
                h = np.bincount(cell, hess[rows], size).reshape(-1, BINS).cumsum(axis=1)
                gr, hr = g[:, -1:] - g, h[:, -1:] - h
                gain = g * g / (h + l2) + gr * gr / (hr + l2) - g[:, -1:] ** 2 / (h[:, -1:] + l2)
                gain[(h < 1) | (hr < 1)] = 0
                for i, b in enumerate(gain.argmax(axis=1).tolist()):
                    if gain[i, b] > best[i][0]:
                        best[i] = (gain[i, b], f, b)
            for (gain, f, b), o in zip(best, open_nodes):
                if gain > 1e-6:
                    self.feature[k, o], self.bin[k, o], self.left[k, o] = f, b, used
                    grown += [used, used + 1]
                    used += 2
            node = self.left[k, node] + (bins[np.arange(len(bins)), self.feature[k, node]] > self.bin[k, node])
            open_nodes = grown
            if not grown:
                break
        g, h = np.bincount(node, grad, self.value.shape[1]), np.bincount(node, hess, self.value.shape[1])
        self.value[k] = -rate * g / (h + l2)
        return self.value[k, node]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row: all rows walk all trees together, level by level."""
        bins, trees = self.binned(x), np.arange(len(self.feature))[None, :]
        node = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        for _ in range(self.depth):
            seen = np.take_along_axis(bins, self.feature[trees, node].astype(np.int64), axis=1)
            node = self.left[trees, node] + (seen > self.bin[trees, node])
        return 1 / (1 + np.exp(-(self.base + self.value[trees, node].sum(axis=1))))


def train(stats: DataFrame, labels: DataFrame, learn_from: Column, rows: int = TRAIN_ROWS) -> Trees | None:
    """Fit on about ``rows`` labelled ids (or all, if fewer) where ``learn_from`` holds."""
    marks = labels.where(learn_from & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marks = written(marks.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")), "quality-labels")
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(1 << 20)
    marks = marks.where(hashed * marks.count() < rows)
    found = stats.join(marks, "doc_id").groupBy("doc_id", "y").agg(F.min("stats").alias("stats"))
    got = sorted(found.collect(), key=lambda r: r.doc_id)
    if not got:
        return None
    return Trees(_matrix([r.stats for r in got]), np.array([r.y for r in got], dtype=np.float64))


def _matrix(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype="<f4").reshape(len(packed), len(FEATURES)).astype(np.float64)


def scores(stats: DataFrame, model: Trees | None) -> DataFrame:
    """Rows ``(doc_id, score)``, one per row of ``stats``."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch["stats"].to_pylist())
        found = np.full(len(x), 0.5) if model is None else model.score(x)
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.float64())], ["doc_id", "score"])

    return arrow_pass(stats, step, "doc_id long, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document: ``doc_id, held_out, score, predicted``."""
    stats = written(document_statistics(table(spark, sf_dir, "documents")), "quality-statistics")
    model = train(stats, table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != HELD_OUT_FOLD)
    return scores(stats, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
