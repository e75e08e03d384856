"""Piece ids against the public library, and the exact round trip."""

import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from importlens.llm import sentencepiece_codec as sc

HARD = ["", " ", "   ", "a", "  lead and  double  ", "tab\tand\nlines\n\n", "naïve café Привет мир 你好 العربية", "🙂🙃 x",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890.5e-7", "<s> </s> <unk> <0x41>", "\x00\x01", "antidisestablishmentarianism"]


@pytest.fixture(scope="module")
def codec():
    return sc.Codec(sc.Vocabulary.read())


def texts():
    rng = random.Random(4)
    letters = "etaoin shrdluETAON .,;-'\n0123éß你"
    return HARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(300)]


def test_ids_of_the_public_library(codec):
    model = sentencepiece.SentencePieceProcessor(model_file=sc.MODEL_PATH)
    for text, ids in zip(texts(), codec.encode(texts())):
        assert ids.tolist() == model.encode(text), text


def test_known_units_are_gathered_and_few_substrings_are_searched(codec, monkeypatch):
    fresh, probed, search = sc.Codec(codec.v), [], np.searchsorted
    monkeypatch.setattr(sc.np, "searchsorted", lambda keys, wanted, *a: probed.append(np.size(wanted)) or search(keys, wanted, *a))
    rng = random.Random(8)
    some = ["".join(rng.choice("etaoinshrdlu") for _ in range(12)) + " stone" for _ in range(400)]
    first = fresh.encode(some)
    # searching every substring takes over 120 a text
    assert sum(probed) < 100 * len(some)
    before = len(fresh.flat)
    assert all(a.tolist() == b.tolist() for a, b in zip(first, fresh.encode(some))) and len(fresh.flat) == before
    assert len(fresh.met) == len(fresh.size) and fresh.size.sum() == before


def test_exact_round_trip(codec):
    for text, ids in zip(texts(), codec.encode(texts())):
        assert codec.decode(ids) == text


def test_unigram_paths_are_best_paths():
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", " "]
    scores = np.array([0, -2.0, -2.5, -3.0, -3.1, -4.2, -1.0])
    v = sc.Vocabulary(pieces, scores, np.array([False] + [True] * 6), [], 0, sc.UNIGRAM, False, False)
    codec = sc.Codec(v)

    def best(text):
        if not text:
            return 0.0
        return max(scores[i] + best(text[len(p):]) for i, p in enumerate(pieces) if i and text.startswith(p))

    rng = random.Random(1)
    for _ in range(100):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 10)))
        ids = codec.encode([text])[0]
        assert "".join(pieces[i] for i in ids) == text
        assert abs(scores[ids].sum() - best(text)) < 1e-9


def test_defined_results(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "some text", 7), (3, "some text", 7), (None, "x▁y", 8), (4, "long words " * 100_000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    got = sc.encoded(docs).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by_id = {r.doc_id: r for r in got}
    assert (by_id[1].token_ids, by_id[1].n_tokens, by_id[2].token_ids) == (None, 0, [])
    assert by_id[4].n_tokens == len(by_id[4].token_ids) >= 200_000
    assert sc.encoded(docs.limit(0)).collect() == []
    kept = sc.encode(docs.withColumn("more", F.lit("m")), sc.Vocabulary.read(), name="ids")
    assert kept.columns == ["doc_id", "text", "token_ids", "more", "ids"]
