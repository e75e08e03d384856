"""Merkle manifest against a plain recursive version."""

import random
import zlib
from hashlib import sha256

import pytest

from importlens.llm import merkle_manifest as mm

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _leaf(d, text):
    return H(*[_field(v) for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)])


def _fold_up(nodes):
    """Root and, per leaf, its siblings level by level."""
    at, proofs, levels = list(range(len(nodes))), [[] for _ in nodes], nodes
    while len(levels) > 1:
        for i, p in enumerate(at):
            first = p - p % 16
            proofs[i].append((levels[first:p], levels[p + 1:first + 16]))
            at[i] = p // 16
        levels = [H(*levels[i:i + 16]) for i in range(0, len(levels), 16)]
    return levels[0], proofs


def brute(docs):
    by = {}
    for d in docs:
        by.setdefault(d["source"], []).append((d["doc_id"] is not None, d["doc_id"] or 0, _leaf(d, d["text"]), d))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: _fold_up([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    root, top = _fold_up([built[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for (_, _, leaf, d), proof in zip(sorted(by[s], key=lambda x: x[:3]), built[s][1]):
            path, shown = proof + top[k], leaf
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0 and d["text"] is not None:
                shown = _leaf(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"]))
            for left, right in path:
                shown = H(*left, shown, *right)
            out.append((d["doc_id"], leaf, built[s][0], root, H(*[x for a, b in path for x in a + b]), shown, shown == root))
    return sorted(out, key=str)


def _docs(seed, sizes):
    rng = random.Random(seed)
    docs = []
    for source, n in sizes.items():
        for _ in range(n):
            i = rng.randrange(10 ** 6) if rng.random() < 0.9 else None
            text = rng.choice([None, "", "abc", "Ärger Über ALLES", "x" * 5000, f"Text {i}"])
            docs.append({"doc_id": i, "text": text, "lang": rng.choice(["de", None]), "source": source, "n_chars": rng.choice([None, 3])})
    return docs


def _got(spark, docs, extra=False):
    df = spark.createDataFrame([tuple(d[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for d in docs], SCHEMA)
    if extra:
        df = df.selectExpr("*", "1 as tree", "2 as index", "3 as digest", "'x' as position")
    return sorted((tuple(r) for r in mm.documents_proved(df.repartition(5)).collect()), key=str)


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 16}, {"a": 17, None: 1, "": 2}, {"a": 256, "b": 257}, {"hot": 4096, "z": 3}, {"hot": 4097 + 16, "Z": 1},
    {f"s{i}": 1 + i % 3 for i in range(40)}], ids=str)
def test_matches_recursion(spark, sizes):
    docs = _docs(1, sizes)
    docs += docs[:2]                                         # repeated rows
    assert _got(spark, docs, extra=True) == brute(docs)


def test_three_tiers(spark, monkeypatch):
    # segments of 16 leaves, so that 600 leaves need three tiers
    monkeypatch.setattr(mm, "CAPACITY", 16)
    monkeypatch.setattr(mm, "HEIGHT", 1)
    monkeypatch.setattr(mm, "_build", _with(mm._build, 16, 1))
    monkeypatch.setattr(mm, "_descend", _with(mm._descend, 16, 1))
    monkeypatch.setattr(mm, "_prove", _with(mm._prove, 16, 1))
    docs = _docs(2, {"hot": 600, "b": 17, None: 1} | {f"s{i}": 1 for i in range(30)})
    assert _got(spark, docs) == brute(docs)


def _with(fn, capacity, height):
    def run(batches):       # in the worker the module is imported afresh
        from importlens.llm import merkle_manifest
        before = merkle_manifest.CAPACITY, merkle_manifest.HEIGHT
        merkle_manifest.CAPACITY, merkle_manifest.HEIGHT = capacity, height
        try:
            yield from getattr(merkle_manifest, name)(batches)
        finally:
            merkle_manifest.CAPACITY, merkle_manifest.HEIGHT = before
    name = fn.__name__
    return run


def test_no_documents(spark):
    assert _got(spark, []) == []


@pytest.mark.parametrize("tall", [False, True])
def test_records_are_completion_order(tall):
    for n in [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096]:
        leaves = [H(str(i)) for i in range(n)]
        b = mm.Builder()
        for x in leaves:
            b.add(x)
        top = b.finish(mm.HEIGHT if tall else None)
        levels = [leaves]
        while len(levels[-1]) > 1 or (tall and len(levels) <= mm.HEIGHT):
            levels.append([H(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        assert [len(x) for x in levels] == mm.widths(n, mm.HEIGHT if tall else None)
        assert top == levels[-1][0] and len(b.log) == sum(map(len, levels))
        s = mm.Segment(bytes.fromhex("".join(b.log)), n, tall)
        for level, nodes in enumerate(levels):
            assert [s.digest(level, i) for i in range(len(nodes))] == nodes
    assert len(b.log) == mm.FULL


def test_paths_pack():
    path = [("", H("a")), (H("b") + H("c"), ""), ("", "")]
    assert mm.unpacked(mm.packed(path)) == path and mm.unpacked(b"") == []
